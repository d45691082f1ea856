"""Token counts that follow edits: a tree of sums over each document's pre-tokens.

The leaves hold runs of pre-tokens with their text; every node holds the characters and tokens below it. An edit
descends by characters to the leaf it begins in, encodes again from the last boundary that the edit cannot move to the
first boundary after it at which old and new pre-tokens meet, and renews the sums on the way up. All else stays. A leaf
that grows beyond twice its size is split.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm import scratch, tokenizer

LEAF = 64
_PIECE = regex.compile(tokenizer.PATTERN)


class CountTree:
    """Characters and tokens of a text's pre-tokens, summed over a binary tree of leaves."""

    def __init__(self, text: str, count, leaf: int = LEAF, kept: list[tuple[int, int]] | None = None):
        """``kept``: characters and tokens of each leaf of the text's tree, of which no pre-token is encoded until an
        edit touches its leaf; without it all are."""
        self.count, self.leaf = count, leaf
        self.encoded = 0  # pre-tokens encoded since the tree was built
        self.leaves: list[tuple[list[int], list[int]] | None]
        if kept is None:
            pieces = _PIECE.findall(text)
            sizes = list(map(len, pieces))
            tokens = list(map(count, pieces))
            self.leaves = [(sizes[k : k + leaf], tokens[k : k + leaf]) for k in range(0, len(sizes), leaf)] or [([], [])]
            kept = [(sum(s), sum(t)) for s, t in self.leaves]
        else:
            kept = kept or [(0, 0)]
            self.leaves = [None] * len(kept)
        ends = list(accumulate(c for c, _ in kept))
        self.texts = [text[end - c : end] for end, (c, _) in zip(ends, kept, strict=True)]
        self._plant(kept)

    def _plant(self, kept: list[tuple[int, int]]) -> None:
        self.width = 1 << (len(kept) - 1).bit_length()
        self.sums = [(0, 0)] * (2 * self.width)
        self.sums[self.width : self.width + len(kept)] = kept
        for k in range(self.width - 1, 0, -1):
            self.sums[k] = self._both(k)

    def leaf_sums(self) -> list[tuple[int, int]]:
        """Characters and tokens of each leaf: what has to be kept of the tree beside the text."""
        return self.sums[self.width : self.width + len(self.leaves)]

    def _leaf(self, k: int) -> tuple[list[int], list[int]]:
        """Pre-tokens of a leaf, which begins at a boundary of pre-tokens whatever lies before it."""
        if self.leaves[k] is None:
            text, end, following = self.texts[k], len(self.texts[k]), k + 1
            while following < len(self.texts) and not self.texts[following]:
                following += 1
            # what follows decides where the last pre-token ends, and the leaf's own end is a boundary
            ahead = text + (self.texts[following][:2] if following < len(self.texts) else "")
            sizes, tokens, at = [], [], 0
            while at < end:
                match = _PIECE.match(ahead, at)
                sizes.append(min(match.end(), end) - at)
                tokens.append(self.count(ahead[at : at + sizes[-1]]))
                at += sizes[-1]
            self.encoded += len(sizes)
            self.leaves[k] = (sizes, tokens)
        return self.leaves[k]

    def _both(self, k: int) -> tuple[int, int]:
        a, b = self.sums[2 * k], self.sums[2 * k + 1]
        return a[0] + b[0], a[1] + b[1]

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf in which a character lies, and the position at which that leaf begins."""
        k, begin = 1, 0
        while k < self.width:
            k *= 2
            if position >= begin + self.sums[k][0] and self.sums[k + 1][0]:
                begin += self.sums[k][0]
                k += 1
        return min(k - self.width, len(self.leaves) - 1), begin

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters ``start:end``; both are brought into the text, and an end before the start counts as it."""
        start = min(max(start, 0), self.sums[1][0])
        end = min(max(end, start), self.sums[1][0])
        shift = len(new) - (end - start)
        # a pre-token depends on two characters after it at most, so those that end two before the edit stay
        first, begin = self.leaf_at(max(start - 2, 0))
        sizes, tokens = self._leaf(first)
        at, keep = begin, 0
        while keep < len(sizes) and at + sizes[keep] <= start - 2:
            at += sizes[keep]
            keep += 1
        # the old text from ``at`` on, leaf by leaf as far as it is needed, and its old boundaries behind the edit
        old, last, reach = self.texts[first][at - begin :], first, begin + len(self.texts[first])
        waiting, meets = deque([(first, begin)]), set()  # leaves whose boundaries are not known yet; places in the new text

        def more(to: int = 0) -> bool:
            """Leaves up to character ``to``, or else as many as double the old text, so that all are joined in linear time."""
            nonlocal old, last, reach
            added, to = [], max(to, reach + len(old))
            while last + 1 < len(self.leaves) and (reach < to or not added):
                last += 1
                if self.texts[last]:
                    waiting.append((last, reach))
                    if reach >= end:
                        meets.add(reach + shift - at)
                    added.append(self.texts[last])
                    reach += len(self.texts[last])
            old += "".join(added)
            return bool(added)

        if reach < end:
            more(end)
        fresh = old[: start - at] + new + old[end - at :]
        fresh_sizes, fresh_tokens, here = sizes[:keep], tokens[:keep], 0
        while True:
            while waiting and (waiting[0][1] < end or waiting[0][1] + shift - at < here):
                k, place = waiting.popleft()
                meets.update(p + shift - at for p in accumulate(self._leaf(k)[0], initial=place) if p >= end)
            if here in meets or here == len(fresh) and not more():
                break
            fresh = old[: start - at] + new + old[end - at :] if len(fresh) != len(old) + shift else fresh
            match = _PIECE.match(fresh, here)
            while match.end() + 2 > len(fresh) and more():
                fresh = old[: start - at] + new + old[end - at :]
                match = _PIECE.match(fresh, here)
            fresh_sizes.append(match.end() - here)
            fresh_tokens.append(self.count(match.group()))
            here = match.end()
            self.encoded += 1
        # old pre-tokens of the leaf in which old and new meet
        meeting, k, place = here - shift + at, first, begin
        while k < last and place + len(self.texts[k]) <= meeting:
            place += len(self.texts[k])
            k += 1
        text = self.texts[first][: at - begin] + fresh[:here]
        if k > first and place == meeting and self.texts[k]:
            k -= 1  # the next leaf begins there: it stays as it is
        elif meeting < place + len(self.texts[k]):
            own, passed = self._leaf(k), 0
            while place < meeting:
                place += own[0][passed]
                passed += 1
            fresh_sizes, fresh_tokens = fresh_sizes + own[0][passed:], fresh_tokens + own[1][passed:]
            text += self.texts[k][len(self.texts[k]) - sum(own[0][passed:]) :]
        self._fill(first, k, fresh_sizes, fresh_tokens, text)

    def _fill(self, first: int, last: int, sizes: list[int], tokens: list[int], text: str) -> None:
        """Put pre-tokens in the place of leaves ``first`` to ``last``: in those leaves if they can hold them, or else in
        as many new ones as that takes."""
        room = last - first + 1
        parts = max(1, -(-len(sizes) // (2 * self.leaf)))
        inside = parts <= room
        each = -(-len(sizes) // parts) or 1 if inside else self.leaf
        leaves = [(sizes[k : k + each], tokens[k : k + each]) for k in range(0, len(sizes), each)]
        if inside:
            leaves += [([], [])] * (room - len(leaves))
        ends = list(accumulate(sum(s) for s, _ in leaves))
        texts = [text[e - sum(s) : e] for e, (s, _) in zip(ends, leaves, strict=True)]
        before = self.leaf_sums()
        self.leaves[first : last + 1], self.texts[first : last + 1] = leaves, texts
        fresh = [(sum(s), sum(t)) for s, t in leaves]
        if not inside:
            self._plant(before[:first] + fresh + before[last + 1 :])
            return
        self.sums[self.width + first : self.width + last + 1] = fresh
        low, high = (self.width + first) // 2, (self.width + last) // 2
        while low:
            for k in range(low, high + 1):
                self.sums[k] = self._both(k)
            low, high = low // 2, high // 2

    def edit_all(self, edits: list[tuple[int, int, str]]) -> None:
        """Edits that all refer to the text as it is now; applied from the last to the first."""
        for start, end, new in sorted(edits, key=lambda e: (e[0], e[1]), reverse=True):
            self.edit(start, end, new)


#: Personal data that the registered query masks; fixed patterns. A name before @ is looked for from its beginning only,
#: or from where the last mask ended, so that none of them goes back over what it has read.
MASKS = {
    "<email>": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "<phone>": r"(?:(?<!\d)\+?\d{1,3} ?)?\(\d{3}\) ?\d{3}-\d{4}(?!\d)",
    "<ip>": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])",
}


def with_mask_edits(docs: DataFrame) -> DataFrame:
    """Add ``edits``: personal data gives way to its mask, and a text that lacks a final newline gets one."""
    scratch.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [(mask, regex.compile(p)) for mask, p in MASKS.items()]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("new", pa.string())]))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part, found = batch.slice(lo, 512), []
                for text in part.column(1).to_pylist():
                    text, edits, taken = text or "", [], 0
                    spans = sorted((m.start(), m.end(), mask) for mask, p in patterns for m in p.finditer(text))
                    for start, end, mask in spans:
                        if start >= taken:
                            edits.append({"start": start, "end": end, "new": mask})
                            taken = end
                    if not text.endswith("\n"):
                        edits.append({"start": len(text), "end": len(text), "new": "\n"})
                    found.append(edits)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, type=kind)], names=["doc_id", "text", "edits"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, edits array<struct<start:int,end:int,new:string>>")


_TREE = "n_pretokens bigint, leaf_chars array<int>, leaf_tokens array<int>"


def keep_trees(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_pretokens, leaf_chars and leaf_tokens of every row: the trees of the texts, to be kept beside them, with
    the columns ``carry``. A null text has the tree of an empty one."""
    scratch.ship(docs.sparkSession)
    vocabulary = vocabulary or tokenizer.default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.load(vocabulary).count
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                trees = [CountTree(text or "", count, leaf) for text in part.column(0).to_pylist()]
                sums = [t.leaf_sums() for t in trees]
                columns = [pa.array([sum(len(s) for s, _ in t.leaves) for t in trees], type=pa.int64()), *(pa.array([[x[c] for x in s] for s in sums], type=pa.list_(pa.int32())) for c in (0, 1))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], names=[*part.schema.names[1:], "n_pretokens", "leaf_chars", "leaf_tokens"])

    kept = docs.select("doc_id", *carry)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)
    return docs.select(docs["text"].alias("text__"), "doc_id", *carry).mapInArrow(run, f"{columns}, {_TREE}")


def recount(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF, with_text: bool = True) -> DataFrame:
    """doc_id, n_tokens, n_encoded, n_chars, n_edits and, if asked for, the edited text with its tree, from kept trees.

    ``docs`` has doc_id, text, edits, leaf_chars and leaf_tokens; only leaves that edits touch are encoded. A null tree
    is built anew.
    """
    scratch.ship(docs.sparkSession)
    vocabulary = vocabulary or tokenizer.default_path()
    kinds = {"n_tokens": pa.int64(), "n_encoded": pa.int64(), "n_chars": pa.int64(), "n_edits": pa.int64()}
    if with_text:
        kinds |= {"text": pa.string(), "leaf_chars": pa.list_(pa.int32()), "leaf_tokens": pa.list_(pa.int32())}
    carried = [c for c in docs.columns if c.startswith("carry_")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer.load(vocabulary).count
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                out: list[tuple] = []
                for text, edits, chars, tokens in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                    kept = None if chars is None or tokens is None else list(zip(chars, tokens, strict=True))
                    tree, edits = CountTree(text or "", count, leaf, kept), edits or []
                    tree.edit_all([(e["start"] or 0, e["end"] or 0, e["new"] or "") for e in edits if e])
                    row = (tree.tokens, tree.encoded, tree.sums[1][0], len(edits))
                    out.append((*row, tree.text, *(list(c) for c in zip(*tree.leaf_sums(), strict=True))) if with_text else row)
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*part.columns[4:], *(pa.array(list(c), type=t) for c, t in zip(columns, kinds.values(), strict=True))], names=[*part.schema.names[4:], *kinds])

    kept = docs.select("doc_id", *carried)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields) + ", n_tokens bigint, n_encoded bigint, n_chars bigint, n_edits bigint" + ", text string, leaf_chars array<int>, leaf_tokens array<int>" * with_text
    return docs.select("text", "edits", "leaf_chars", "leaf_tokens", "doc_id", *carried).mapInArrow(run, schema)


def count_edited(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF, with_text: bool = False) -> DataFrame:
    """doc_id, n_pretokens, n_tokens, n_edits, n_encoded, n_tokens_edited, n_chars_edited (and text_edited if asked for).

    ``docs`` has doc_id, text and ``edits``, an array of (start, end, new) in characters of the text, not overlapping.
    The texts' trees are kept as a table first; the edits then read that table and encode what they touch only:
    n_encoded pre-tokens. A null text is empty, null edits are none, and in an edit null start and end are 0 and a null
    ``new`` deletes. A text of any length is counted whole. Every row is counted for itself, repeated ones too; an empty
    table gives an empty result. A special token's string counts as ordinary text.
    """
    trees = scratch.keep(keep_trees(docs, vocabulary, leaf, ("text", "edits")), "trees")
    before = F.aggregate("leaf_tokens", F.lit(0).cast("long"), lambda s, x: s + x)
    trees = trees.withColumns({"carry_pretokens": F.col("n_pretokens"), "carry_tokens": before})
    found = recount(trees, vocabulary, leaf, with_text)
    columns = [F.col("carry_pretokens").alias("n_pretokens"), F.col("carry_tokens").alias("n_tokens"), "n_edits", "n_encoded", F.col("n_tokens").alias("n_tokens_edited"), F.col("n_chars").alias("n_chars_edited")]
    return found.select("doc_id", *columns, *[F.col("text").alias("text_edited")] * with_text)
