"""One row of each component where ids repeat or are missing."""

from blockledger.llm import ngram_join as J


def text(name):
    return " ".join(f"{name}{k}" for k in range(60))


def kept(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return [tuple(r) for r in J.one_of_each(df).collect()]


def test_repeated_and_missing_ids(spark):
    near = text("d").replace("d59", "other")
    assert kept(spark, [(1, text("t")), (None, text("t")), (None, text("t"))]) == [(1, text("t"))]
    rows = [(1, text("a")), (1, text("b")), (2, text("b")), (2, text("c")), (2, text("c")),  # one id, several texts
            (None, text("d")), (None, text("d")), (None, near),  # a group without any id
            (None, text("e")), (None, ""), (None, None), (7, ""), (7, "")]
    got = kept(spark, rows)
    d = [t for i, t in got if i is None and t in (text("d"), near)]
    assert len(d) == 1
    rest = sorted([r for r in got if r != (None, d[0])], key=str)
    assert rest == sorted([(1, text("a")), (1, text("b")), (2, text("c")), (None, text("e")), (None, ""), (None, None), (7, "")], key=str)
