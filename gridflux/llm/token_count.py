"""Edit-aware token counts: per-document segment trees over pre-token runs.

A document is split into leaves, runs of whole pre-tokens of about
``LEAF_CHARS`` characters.  A leaf ends only where every byte-level pre-tokenizer
of this kind starts a new pre-token, whatever stands to the left: before white
space that follows something else, between a letter and a number, and before
most punctuation after a letter.  So token counts of leaves add up to the count
of the text, and text without spaces has leaves too (but a run of letters is one
pre-token, hence one leaf).  A segment tree holds the leaves' lengths in
characters and token counts.  An edit (replace characters [start, end) by other
text) finds its leaves by descending the tree, re-encodes these and the
neighbours to which the old boundary no longer holds, and updates the sums above
them.

Defined cases: a null or empty text has no leaf and count 0; edits apply in the
order of their starts and refer to the text before any of them, those that
overlap an earlier one or lie outside are skipped; special strings count as
their special ids; repeated rows each have their own tree; an empty table gives an empty
table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from gridflux.llm.common import table
from gridflux.llm.tokens import Encoder, encoder, read_vocabulary

LEAF_CHARS = 512
#: Two characters between which a pre-token starts.  Contractions start with ', and
#: special strings hold marks between < and >, so these bound no leaf.
SAFE = regex.compile(r"\S\s|\p{L}[^\s\p{L}'|<>]|\p{N}\p{L}")
BOUNDARY = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}'|<>])|(?<=\p{N})(?=\p{L})")
#: Personal data that the default edits redact: mail addresses, long numbers and phone numbers.
PERSONAL = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+|\+?\(?\d[\d ()./-]{6,}\d")


def split_leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """Parts of ``text`` that end at safe boundaries, of at least about ``size`` characters."""
    out, at = [], 0
    while len(text) - at > size:
        cut = BOUNDARY.search(text, at + size)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.start()
    if at < len(text):
        out.append(text[at:])
    return out


class SegmentTree:
    """Sums of (characters, tokens) over leaves, in an implicit binary tree."""

    def __init__(self, leaves: list[str], tokens: list[int]):
        self.leaves = leaves
        self.width = 1 << max(0, (len(leaves) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        if leaves:
            self.sums[self.width : self.width + len(leaves)] = np.column_stack(([len(x) for x in leaves], tokens))
        level = self.width
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level = half

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    def find(self, position: int) -> tuple[int, int]:
        """(leaf that holds the character, position in it); the end is in the last leaf."""
        node = 1
        while node < self.width:
            node *= 2
            if position >= self.sums[node, 0] and self.sums[node + 1, 0]:
                position -= int(self.sums[node, 0])
                node += 1
        return node - self.width, position

    def set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.width
        change = np.array((len(text), tokens)) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def text(self) -> str:
        return "".join(self.leaves)


def build(text: str, enc: Encoder) -> SegmentTree:
    leaves = split_leaves(text)
    return SegmentTree(leaves, [len(enc.ids(x)) for x in leaves])


def _safe(left: str, right: str) -> bool:
    """Whether a boundary between two texts is still one of pre-tokens."""
    return not left or not right or SAFE.match(left[-1] + right[0]) is not None


def apply_edit(tree: SegmentTree, start: int, end: int, new: str, enc: Encoder) -> int:
    """Replace characters [start, end); returns how many leaves were re-encoded."""
    if not tree.leaves:
        tree.__init__([new], [len(enc.ids(new))]) if new else None
        return int(bool(new))
    a, offset = tree.find(start)
    b, stop = tree.find(end)
    first, last = a, b
    middle = tree.leaves[a][:offset] + new + tree.leaves[b][stop:]
    # Boundary context: take in neighbours while the bounds to them don't hold;
    # leaves that an earlier edit emptied hold nothing.
    n = len(tree.leaves)
    while True:
        left = next((k for k in range(first - 1, -1, -1) if tree.leaves[k]), None)
        right = next((k for k in range(last + 1, n) if tree.leaves[k]), None)
        if left is not None and (not middle and right is not None and not _safe(tree.leaves[left], tree.leaves[right]) or middle and not _safe(tree.leaves[left], middle)):
            middle, first = tree.leaves[left] + middle, left
        elif right is not None and middle and not _safe(middle, tree.leaves[right]):
            middle, last = middle + tree.leaves[right], right
        else:
            break
    tree.set(first, middle, len(enc.ids(middle)) if middle else 0)
    for k in range(first + 1, last + 1):
        tree.set(k, "", 0)
    return last - first + 1


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that redact personal data."""
    return [(m.start(), m.end(), "<REDACTED>") for m in PERSONAL.finditer(text)]


def recount(tree: SegmentTree, edits: list[tuple[int, int, str]], enc: Encoder) -> int:
    """Apply edits, given for the text before any of them; leaves re-encoded."""
    shift = done = reach = 0
    size = int(tree.sums[1, 0])
    for start, end, new in sorted(edits):
        if start < reach or end < start or end > size:
            continue
        done += apply_edit(tree, start + shift, end + shift, new, enc)
        shift += len(new) - (end - start)
        reach = end
    return done


COUNTS = "doc_id long, n_leaves int, n_tokens long, n_edits int, leaves_encoded int, n_tokens_after long, n_chars_after long, tree_tokens array<int>"


def count_tokens(docs: DataFrame, make_edits=redactions, vocabulary: str | None = None) -> DataFrame:
    """Token counts of whole texts before and after the edits that ``make_edits``
    finds in them, and the tree's leaf counts after them, by which the next
    edits go on."""
    blob = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(blob.value)
        names = [x.split()[0] for x in COUNTS.split(", ")]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    text = text.as_py() or ""
                    tree = build(text, enc)
                    n, before, edits = len(tree.leaves), tree.total, make_edits(text)
                    encoded = recount(tree, edits, enc) if edits else 0
                    leaves = tree.sums[tree.width : tree.width + len(tree.leaves), 1]
                    rows.append((doc, n, before, len(edits), encoded, tree.total, int(tree.sums[1, 0]), leaves.tolist()))
                cols = list(zip(*rows, strict=True)) or [()] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, COUNTS)


def op2_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
