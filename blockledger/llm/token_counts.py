"""Token counts with a whole-token shortcut, for a lower-casing BPE with word ends.

Offline, every vocabulary string that ends a word is encoded by the library: if
it comes back as its own single id, a pre-token equal to it is always one token,
since merges never cross pre-tokens.  That proven set goes to the tasks.  There
a text is cut at ASCII white space, which no token crosses.  A piece in the
proven set counts 1 at once; other pieces of common Latin characters are split
into pre-tokens by the tokenizer's pattern, each counted 1 if proven and merged
by the library if not; pieces with anything else (other scripts, combining
marks, special strings) are encoded whole by the library.  Counts of short
pieces are remembered up to a bound.

Cases: a null text counts as empty; ids, ties, repeated rows and other columns
do not matter; an empty table gives no rows; texts of any length are read
whole, piece by piece.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

LIMIT = 2048
REMEMBERED = 500_000
LONGEST = 64  # bytes of a piece that is remembered

# ASCII and precomposed Latin-1: same lower case and same normal form everywhere.
_PLAIN = re.compile("[\x21-\x7eÀ-ÿ]+")
_LETTER = "a-zß-öø-ÿ"
#: Fixed value: the tokenizer's own pattern, for lower-cased plain pieces.
_PATTERN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_LETTER}0-9]+")


def proven_words(tokenizer_file: str) -> frozenset[str]:
    """Plain vocabulary words that the library encodes as their own single id."""
    tok = Tokenizer.from_file(tokenizer_file)
    vocab = tok.get_vocab(with_added_tokens=False)
    mapped = {chr(c): bytes([b]) for b, c in _byte_chars().items()}
    words = {}
    for piece, id_ in vocab.items():
        if piece.endswith("</w>") and all(ch in mapped for ch in piece[:-4]):
            try:
                word = b"".join(mapped[ch] for ch in piece[:-4]).decode()
            except UnicodeDecodeError:
                continue
            if _PLAIN.fullmatch(word) and word == word.lower():
                words[word] = id_
    names = list(words)
    got = tok.encode_batch(names, add_special_tokens=False)
    return frozenset(w for w, e in zip(names, got) if e.ids == [words[w]])


def _byte_chars() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


class Counts(dict):
    """Piece (bytes without ASCII white space) to its number of tokens."""

    def __init__(self, tokenizer_file: str, proven: frozenset[str]):
        super().__init__()
        self.tok = Tokenizer.from_file(tokenizer_file)
        self.proven, self.merged = proven, {}

    def library(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def merge(self, word: str) -> int:
        n = self.merged.get(word)
        if n is None:
            n = self.library(word)
            if len(word) <= LONGEST:
                if len(self.merged) >= REMEMBERED:
                    self.merged.clear()
                self.merged[word] = n
        return n

    def __missing__(self, piece: bytes) -> int:
        text = piece.decode()
        if not _PLAIN.fullmatch(text) or "<|" in text:
            n = self.library(text)
        else:
            low, proven = text.lower(), self.proven
            n = 1 if low in proven else sum(
                1 if w in proven else self.merge(w) for w in _PATTERN.findall(low))
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs``."""
    proven = proven_words(tokenizer_file)

    def run(batches):
        counts = Counts(tokenizer_file, proven)
        for b in batches:
            size, n = [], []
            for t in b.column("text"):
                raw = t.as_py() or b""
                size.append(len(raw))
                n.append(sum(map(counts.__getitem__, raw.split())))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
