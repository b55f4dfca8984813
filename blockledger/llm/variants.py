"""Spelling variants by finite-state composition.

The near pairs of a vocabulary A are what the composition A . E . A accepts, E
being the transducer that copies a word but for one inserted, deleted or
replaced code point.  Its states are (prefix, 0 edits, same prefix) while E
copies, and (state, 1 edit, state) once the edit is spent; then only equal
rests are accepted.

The composition is spread over tasks by its initial states:

* Starting from the empty prefix, a copying state whose words are more than
  ``AT_ONCE`` is expanded by Spark: each of its words moves on to the state one
  letter further, and the edit may be spent right here.  A state with the edit
  spent is named by the prefix and the rest, which has to be equal, so its words
  meet under that key: at most one for each letter, and one that skips it.
* A copying state with at most ``AT_ONCE`` words is one partition of the
  enumeration: its words' rests become a minimised acceptor (equal right
  languages share a state), and the composition with the edit transducer is
  enumerated over pairs of states, each pair once.

An insertion into a run of equal letters could be spent at several places; E
allows only the last, so every pair is accepted once.  Each partition adds up per
word how many near words it has and the largest of them; the sums are combined.

Words are counted over whole texts.  The occurrences of a run in a text share
one hash, so a text counts its runs first.

Cases: a null text has no words, a null id counts as an empty one; ties go to the
word that is smaller in code points; repeated rows count as often as they occur;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockledger.llm.common import discard, saved

LEAST_LENGTH, LEAST_COUNT = 6, 5
DAMAGE = 199  # a run is damaged where its hash is a multiple of it
DOMINANCE = 5  # how many times as frequent a word's form is
AT_ONCE = 20_000  # words of an initial state that one task enumerates
HELD = 400_000  # words counted before they leave a task

RUN = re.compile("[A-Za-zÀ-ÿ]+")


# ------------------------------------------------------------------ vocabulary

def runs(text: bytes) -> Counter:
    """The letter runs of a text, A-Z lower-cased, and how often each occurs."""
    return Counter(RUN.findall(text.lower().decode(errors="replace")))


def damaged(run: str, h: int) -> str:
    """The run without one code point where the hash says so."""
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``length`` code points that occur at least ``count`` times."""
    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for i in range(b.num_rows):
                text = b.column("text")[i].as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{b.column('id')[i].as_py()}:".encode())
                for w, n in runs(text).items():
                    w = damaged(w, zlib.crc32(w.encode(), start))
                    if len(w) >= length:
                        held[w] += n
                if len(held) > HELD:
                    yield part(held)
                    held.clear()
        yield part(held)

    def part(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    src = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text"))
    return (src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count))


# ----------------------------------------------------- acceptor and composition

class Acceptor:
    """The minimised acceptor of a set of words: states are numbered, equal right languages once."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict = {}
        path: list[tuple[dict, list]] = [({}, [False])]  # states not yet numbered, from the start
        before = ""
        for w in sorted(words):
            same = 0
            while same < min(len(w), len(before)) and w[same] == before[same]:
                same += 1
            self._number(path, before, same)
            path += [({}, [False]) for _ in w[same:]]
            path[-1][1][0] = True
            before = w
        self._number(path, before, 0)
        self.start = self._state(*path[0])

    def _number(self, path: list, word: str, down_to: int) -> None:
        while len(path) - 1 > down_to:
            arcs, final = path.pop()
            path[-1][0][word[len(path) - 1]] = self._state(arcs, final)

    def _state(self, arcs: dict, final: list) -> int:
        key = (final[0], *arcs.items())
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final[0])
        return self._known[key]


class OneEdit:
    """Enumerates the pairs that the acceptor, the one-edit transducer and the acceptor again accept."""

    def __init__(self, a: Acceptor):
        self.a = a
        #: Pairs of states after the edit: (both final, arcs to pairs that accept something), or None.
        self.spent: dict[tuple[int, int], tuple[bool, list] | None] = {}
        self.here: dict[int, list[tuple[str, str]]] = {}

    def after(self, p: int, q: int) -> tuple[int, int]:
        """The pair's key, with all pairs that it reaches worked out (no recursion: words may be long)."""
        top = (p, q) if p <= q else (q, p)
        stack, spent, arcs, final = [top], self.spent, self.a.arcs, self.a.final
        while stack:
            key = stack[-1]
            if key in spent:
                stack.pop()
                continue
            x, y = arcs[key[0]], arcs[key[1]]
            if len(y) < len(x):
                x, y = y, x
            to = [(c, (s, t) if s <= t else (t, s)) for c, s in x.items() if (t := y.get(c)) is not None]
            waits = [k for _, k in to if k not in spent]
            if waits:
                stack += waits
                continue
            to, both = [e for e in to if spent[e[1]]], final[key[0]] and final[key[1]]
            spent[key] = (both, to) if both or to else None
            stack.pop()
        return top

    def equal_rests(self, p: int, q: int) -> Iterator[str]:
        """What both states accept: the composition after its edit."""
        key = self.after(p, q)
        stack = [("", key)] if self.spent[key] else []
        while stack:
            rest, key = stack.pop()
            both, to = self.spent[key]
            if both:
                yield rest
            stack += [(rest + c, k) for c, k in to]

    def edits(self, q: int) -> list[tuple[str, str]]:
        """Pairs of rests from a copying state whose edit is spent at once."""
        out = self.here.get(q)
        if out is None:
            out = []
            arcs = sorted(self.a.arcs[q].items())
            for i, (c, s) in enumerate(arcs):
                for d, t in arcs[i + 1:]:
                    out += [(c + rest, d + rest) for rest in self.equal_rests(s, t)]
                # One side has the letter more; in a run of equal letters, the last one.
                out += [(c + rest, rest) for rest in self.equal_rests(s, q) if rest[:1] != c]
            self.here[q] = out
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        stack = [("", self.a.start)]
        while stack:
            path, q = stack.pop()
            for x, y in self.edits(q):
                yield path + x, path + y
            stack += [(path + c, s) for c, s in self.a.arcs[q].items()]


def near_in(words: dict[str, int]) -> dict[str, list]:
    """word -> [near words, the largest's -n, the largest] among ``words`` (word -> n)."""
    out: dict[str, list] = defaultdict(lambda: [0, 1, ""])
    for v, w in OneEdit(Acceptor(list(words))).pairs():
        for x, y in ((v, w), (w, v)):
            got = out[x]
            got[0] += 1
            if (-words[y], y) < (got[1], got[2]):
                got[1], got[2] = -words[y], y
    return out


NEAR = "word string, near long, neg long, best string"


def enumerated(leaves: DataFrame) -> DataFrame:
    """Per word of each partition (prefix, word, n) its near words there, by composition."""
    def run(t: pa.Table) -> pa.Table:
        prefix = t.column("prefix")[0].as_py()
        k = len(prefix)
        words = {w[k:]: n for w, n in zip(t.column("word").to_pylist(), t.column("n").to_pylist())}
        rows = [(prefix + w, n, neg, prefix + best) for w, (n, neg, best) in near_in(words).items()]
        return pa.table([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "near", "neg", "best"])

    return leaves.groupBy("prefix").applyInArrow(run, NEAR)


def spent_here(words: DataFrame, k: int) -> DataFrame:
    """Per word its near words by an edit at place k of copying states (prefix of k letters).

    A word that moves past a letter and one that does not meet if their rests are
    equal; under one key no two words move past the same letter.
    """
    p = F.substr("word", F.lit(1), F.lit(k))
    past = F.struct(F.lit(True).alias("moved"), F.substr("word", F.lit(k + 2)).alias("rest"))
    stays = F.struct(F.lit(False).alias("moved"), F.substr("word", F.lit(k + 1)).alias("rest"))
    steps = F.when(F.length("word") > k, F.array(past, stays)).otherwise(F.array(stays))
    met = (words.select("word", "n", p.alias("p"), F.explode(steps).alias("s"))
           .groupBy("p", "s.rest").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("neg"), "word", "s.moved"))).alias("ws"))
           .filter(F.size("ws") > 1))
    # A letter skipped before an equal one is skipped there already: that pair counts at the last of them.
    letter = lambda w: F.substr(w["word"], F.lit(k + 1), F.lit(1))
    first = F.substr(F.col("rest"), F.lit(1), F.lit(1))
    skips = lambda x: (letter(x) != first) | (F.col("rest") == "")
    near = F.filter("ws", lambda x: (x["word"] != F.col("w.word")) & F.when(
        x["moved"] & F.col("w.moved"), True).when(x["moved"], skips(x)).otherwise(skips(F.col("w"))))
    return (met.withColumn("w", F.explode("ws")).select(F.col("w.word").alias("word"), near.alias("x")).filter(F.size("x") > 0)
            .select("word", F.size("x").cast("long").alias("near"), F.col("x")[0]["neg"].alias("neg"), F.col("x")[0]["word"].alias("best")))


def near_words(vocab: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """(word, n_near, neg, best): of every word with near words their number and the largest one (neg: its -n)."""
    parts, leaves, k = [], [], 0
    open_ = vocab.select("word", "n", F.lit("").alias("prefix"))
    while True:
        size = saved(open_.groupBy("prefix").agg(F.count("*").alias("m")).filter(F.col("m") > at_once).select("prefix"), "variants-large")
        if size.isEmpty():
            leaves.append(open_)
            break
        leaves.append(open_.join(size, "prefix", "left_anti"))
        large = saved(open_.join(size, "prefix", "left_semi").select("word", "n"), "variants-open")
        parts.append(spent_here(large, k))
        k += 1
        open_ = large.filter(F.length("word") >= k).withColumn("prefix", F.substr("word", F.lit(1), F.lit(k)))
    leaf = leaves[0].select("prefix", "word", "n")
    for x in leaves[1:]:
        leaf = leaf.unionByName(x.select("prefix", "word", "n"))
    near = enumerated(leaf)
    for x in parts:
        near = near.unionByName(x)
    return (near.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("neg", "best")).alias("x"))
            .select("word", "n_near", "x.neg", "x.best"))


# ------------------------------------------------------------------- operator

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, doubling the step each time."""
    at = saved(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        far = at.join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        if far.filter("next is not null").isEmpty():
            return at
        step = saved(far.select("word", F.coalesce("next", "root").alias("root")), "variants-roots")
        discard(at)
        at = step


def grouped(vocab: DataFrame, dominance: int = DOMINANCE, at_once: int = AT_ONCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row (word, n) of a vocabulary without repeats."""
    near = saved(near_words(vocab, at_once), "variants-near")
    rows = vocab.join(near, "word", "left")
    is_form = -F.col("neg") >= dominance * F.col("n")
    rows = saved(rows.select("word", F.when(is_form, F.col("best")).alias("form"), "n",
                             F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, -F.col("neg")).alias("form_n")),
                 "variants-forms")
    last = roots(rows.filter("form is not null"))
    return rows.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT, dominance: int = DOMINANCE,
                      at_once: int = AT_ONCE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    return grouped(saved(vocabulary(docs, length, count), "variants-words"), dominance, at_once)
