"""Edit-aware token counts: a segment tree of pre-token runs for each document.

A leaf is a run of whole pre-tokens that ends where a space follows a character that is not white
space; no pre-token spans such a place, so leaves count by themselves. Inner nodes hold the sums of
tokens and characters of their halves. An edit re-encodes only the leaves it touches and, as
context, the leaf before and after, where it may have undone a boundary; the sums up the tree then
follow.

Defined cases: a null text is an empty one of 0 tokens; edits outside a text are clipped to it;
edits of one document apply in their order, each to the text that the one before left; a document
without edits keeps its count; repeated rows are counted alike; an empty table gives an empty
result. Extra columns are ignored. A narrow map without shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encoding, stable_right
from .common import table

RUN = 256


def cut(text: str) -> list[str]:
    """Runs of pre-tokens of about RUN characters."""
    out, at = [], 0
    while at < len(text):
        end = stable_right(text, min(at + RUN, len(text)), len(text)) if at + RUN < len(text) else len(text)
        out.append(text[at:end])
        at = end
    return out


class CountTree:
    """Token and character sums over a document's runs, kept under edits."""

    def __init__(self, text: str, count: Callable[[str], int]):
        self.count, self.encoded = count, 0
        self.runs = cut(text)
        self._build([self._leaf(x) for x in self.runs])

    def _leaf(self, run: str) -> tuple[int, int]:
        self.encoded += len(run)
        return self.count(run), len(run)

    def _build(self, leaves: list[tuple[int, int]]) -> None:
        self.size = 1 << max(0, (len(leaves) - 1).bit_length())
        self.sums = [(0, 0)] * self.size + leaves + [(0, 0)] * (self.size - len(leaves))
        for i in range(self.size - 1, 0, -1):
            self._pull(i)

    def _pull(self, i: int) -> None:
        (a, b), (c, d) = self.sums[2 * i], self.sums[2 * i + 1]
        self.sums[i] = (a + c, b + d)

    @property
    def tokens(self) -> int:
        return self.sums[1][0]

    @property
    def chars(self) -> int:
        return self.sums[1][1]

    def find(self, at: int) -> tuple[int, int]:
        """The run that holds character ``at`` (the last one at the end) and its offset there."""
        i, at = 1, min(at, self.chars)
        while i < self.size:
            i *= 2
            if at >= self.sums[i][1] and self.sums[i + 1][1]:
                at -= self.sums[i][1]
                i += 1
        return i - self.size, at

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace characters start..stop by ``new``, re-encoding touched runs and their neighbours only."""
        start = max(0, min(start, self.chars))
        stop = max(start, min(stop, self.chars))
        first, off = self.find(start)
        last, end = self.find(stop)
        lo, hi = max(0, first - 1), min(len(self.runs), last + 2)
        head, tail = "".join(self.runs[lo:first]), "".join(self.runs[last + 1 : hi])
        middle = (self.runs[first][:off] if self.runs else "") + new + (self.runs[last][end:] if self.runs else "")
        fresh = cut(head + middle + tail)
        if hi < len(self.runs) and fresh and not self._sealed(fresh[-1], self.runs[hi]):
            while hi < len(self.runs) and not self._sealed(fresh[-1], self.runs[hi]):
                fresh[-1:] = cut(fresh[-1] + self.runs[hi])
                hi += 1
        if not fresh and 0 < lo and hi < len(self.runs):  # all between was deleted: the sides meet
            lo, fresh, hi = lo - 1, cut(self.runs[lo - 1] + self.runs[hi]), hi + 1
        if lo and fresh and not self._sealed(self.runs[lo - 1], fresh[0]):
            lo, fresh = lo - 1, cut(self.runs[lo - 1] + "".join(fresh))
        leaves = [self._leaf(x) for x in fresh]
        if len(fresh) == hi - lo:
            self.runs[lo:hi] = fresh
            touched = set()
            for i, leaf in enumerate(leaves, self.size + lo):
                self.sums[i] = leaf
                touched.add(i // 2)
            while touched and max(touched) >= 1:
                for i in touched:
                    self._pull(i)
                touched = {i // 2 for i in touched if i > 1}
        else:
            kept = self.sums[self.size : self.size + len(self.runs)]
            self.runs[lo:hi] = fresh
            self._build(kept[:lo] + leaves + kept[hi:])

    @staticmethod
    def _sealed(left: str, right: str) -> bool:
        return right[0] in " \n" and not left[-1].isspace()


def count_documents(docs: DataFrame, edits: Callable[[int | None, str], list[tuple[int, int, str]]], vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_chars, n_tokens, n_edits, chars_after, tokens_after, chars_reencoded; ``edits`` gives a document's edits."""
    schema = "doc_id bigint, n_chars bigint, n_tokens bigint, n_edits bigint, chars_after bigint, tokens_after bigint, chars_reencoded bigint"
    names = schema.replace(" bigint", "").split(", ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(vocabulary).encode_ordinary
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py() or ""
                tree = CountTree(text, lambda s: len(encode(s)))
                before, built, todo = tree.tokens, tree.encoded, edits(doc_id, text)
                for edit in todo:
                    tree.edit(*edit)
                rows.append((doc_id, len(text), before, len(todo), tree.chars, tree.tokens, tree.encoded - built))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def revision(doc_id: int | None, text: str) -> list[tuple[int, int, str]]:
    """The query's edits of a document: a phrase put in at a place that its id sets, 40 characters cut out after it, the first character set again."""
    at = (doc_id or 0) * 7919 % (len(text) + 1)
    return [(at, at, " [edited:\n 12's] "), (at + 60, at + 100, ""), (0, 1, text[:1].upper())]


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_documents(table(spark, sf_dir, "documents"), revision)
