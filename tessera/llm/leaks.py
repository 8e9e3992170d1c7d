"""Passages of held-out test items inside a corpus.

Texts are compared by their letters and digits only. A test item is cut into consecutive pieces so short that every
window of a passage's least length holds one piece more than the error budget; of these pieces one at least is free
of errors (pigeonhole). All pieces of all items are looked up in a document in one pass (Aho-Corasick). Around every
hit the windows that hold the piece are verified by Myers' bit-parallel edit distance, for every error budget alike,
and the verified windows are joined to the share of the item that the document holds.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.session import spread

#: Letters of test items that one pass over the corpus holds at a time; more items take more passes.
BLOCK_LETTERS = 5_000_000

#: Tags, and targets of links; both stop at the next bracket, so that they are found in linear time at any length.
_TAGS = re.compile(r"</?[A-Za-z][^<>]*>|(?<=\])\([^()\s]+(?:\s+\"[^\"()]*\")?\)")
_REST = re.compile(r"[\W_]+")


def _without_comments(text: str) -> str:
    out, at = [], 0
    while (a := text.find("<!--", at)) >= 0 and (b := text.find("-->", a + 4)) >= 0:
        out.append(text[at:a])
        at = b + 3
    return "".join([*out, text[at:]]) if out else text


def without_markup(text: str) -> str:
    """The text without tags, comments, link targets and entities, whatever their length."""
    if "<" in text or "](" in text or "&" in text:
        text = _TAGS.sub("", _without_comments(text))
        if "&" in text:
            text = _TAGS.sub("", _without_comments(html.unescape(text)))
    return text


def letters(text: str) -> str:
    """Letters and digits of a text: case-folded, compatibility forms and decomposed letters made one."""
    fold = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", without_markup(text)).casefold())
    return _REST.sub("", fold)


def weights(text: str) -> list[int]:
    """For each of ``letters(text)`` whether it begins a letter or digit of the text (a ligature counts once)."""
    out: list[int] = []
    for x in unicodedata.normalize("NFC", without_markup(text)):
        n = len(_REST.sub("", unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", x).casefold())))
        out += [1, *[0] * (n - 1)] if n else []
    return out


@lru_cache(1 << 14)
def _masks(pattern: str) -> dict[str, int]:
    """Places of each letter of a pattern, as bits."""
    masks: dict[str, int] = {}
    for i, x in enumerate(pattern):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def myers(pattern: str, text: str, most: int | None = None) -> int:
    """Least edit distance of ``pattern`` to any substring of ``text`` (Myers' bit-parallel algorithm).

    With ``most`` the scan stops as soon as it is certain whether the distance is ``most`` or less; what is returned
    is then on the same side of ``most`` as the distance.
    """
    m = len(pattern)
    if not m:
        return 0
    masks = _masks(pattern)
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, left = m, len(text)
    low, slack = (-1, None) if most is None else (most, most)
    for x in text:
        eq = masks.get(x, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        left -= 1
        if score < best:
            best = score
            if best <= low:
                return best
        if slack is not None and score - left > slack:
            return best
    return best


@lru_cache(1 << 14)  # stock sentences come again and again
def verified(context: str, p: int, text: str, s: int, run: int, piece: int, errors: int) -> int:
    """Letters (bits) of ``context`` in windows that ``text`` holds within the error budget, around a hit.

    The piece lies at ``p`` in the context and at ``s`` in the text; the windows are those of ``run`` letters with it.
    """
    n, at, right = len(context), s - p, p + piece

    def near(a: int, b: int) -> bool:
        return myers(context[a:b], text[max(0, at + a - errors) : max(0, at + b + errors)], errors) <= errors

    if near(0, n):
        return (1 << n) - 1
    # every window holds half of what is beside the piece on one side of it
    half = (run - piece + 1) // 2
    if not (p >= half and near(p - half, right) or n - right >= half and near(p, right + half)):
        return 0
    mask, a = 0, 0
    while a <= min(p, n - run):
        if not near(a, a + run):
            a += 1
            continue
        # a longer stretch within the budget holds all its windows
        low, high = a + run, n + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if near(a, mid) else (low, mid)
        mask |= ((1 << (low - a)) - 1) << a
        a = low - run + 1
    return mask


class ItemIndex:
    """The pieces of a block of test items.

    A place of a piece is known by its context, the letters of the item that windows with the piece can reach. Places
    of equal context (stock sentences that many items share) are one class, which is verified once a hit whatever
    the number of its items. An item is asked for only when a class is held that is none of its commonest: the
    commonest classes of an item, as many as hold less than ``share`` of it together, cannot bring it there alone.
    """

    def __init__(self, items: list[tuple[int, str]], run: int, errors: int, share: float = 0.0):
        import ahocorasick

        self.run, self.errors = run, errors
        self.piece = (run + 1) // (errors + 2)
        if self.piece < 1:
            raise ValueError("the error budget is too large for this length of passage")
        self.ids: list[int] = []
        self.counted: list[int] = []  # letters of an item that count, as bits
        self.parts: list[list[tuple[int, int]]] = []  # classes of an item, with the place of their context
        self.contexts: list[tuple[str, int]] = []  # letters, and where the piece lies in them
        classes: dict[tuple[str, int], int] = {}
        where: dict[str, list[int]] = defaultdict(list)
        members: list[int] = []
        for i, raw in items:
            t, w = letters(raw), weights(raw)
            if len(t) < run:
                continue
            w = w if len(w) == len(t) else [1] * len(t)
            parts = []
            for p in range(0, len(t) - self.piece + 1, self.piece):
                a = max(0, p + self.piece - run)
                key = (t[a : p + run], p - a)
                c = classes.setdefault(key, len(classes))
                if c == len(self.contexts):
                    self.contexts.append(key)
                    members.append(0)
                    where[t[p : p + self.piece]].append(c)
                members[c] += 1
                parts.append((c, a))
            self.ids.append(i)
            self.counted.append(sum(1 << k for k, x in enumerate(w) if x))
            self.parts.append(parts)
        self.asks: list[list[int]] = [[] for _ in self.contexts]
        for k, parts in enumerate(self.parts):
            reach, need = 0, share * self.counted[k].bit_count() - 1e-9
            for c, a in sorted(parts, key=lambda x: -members[x[0]]):
                reach |= ((1 << len(self.contexts[c][0])) - 1) << a
                if (reach & self.counted[k]).bit_count() >= need:
                    self.asks[c].append(k)
        self.automaton = ahocorasick.Automaton() if where else None
        if where:
            for piece, cs in where.items():
                self.automaton.add_word(piece, cs)
            self.automaton.make_automaton()

    def held(self, text: str) -> dict[int, int]:
        """Per class the letters of its context, as bits, that lie in verified windows of ``text`` (letters)."""
        found: dict[int, int] = {}
        if self.automaton is None or len(text) < self.run - self.errors:
            return found
        for end, cs in self.automaton.iter(text):
            s = end + 1 - self.piece
            for c in cs:
                have = found.get(c, 0)
                context, p = self.contexts[c]
                if have.bit_count() < len(context):
                    a = max(0, s - p - self.errors)
                    if more := verified(context, p, text[a : s - p + len(context) + self.errors], s - a, self.run, self.piece, self.errors):
                        found[c] = have | more
        return found

    def shares(self, text: str) -> list[tuple[int, float]]:
        """Items asked for and the share of their letters and digits that lie in passages of the text."""
        held = self.held(letters(text))
        out = []
        for k in sorted({k for c in held for k in self.asks[c]}):
            mask = 0
            for c, a in self.parts[k]:
                mask |= held.get(c, 0) << a
            out.append((self.ids[k], (mask & self.counted[k]).bit_count() / self.counted[k].bit_count()))
        return out


_INDEX: dict[str, ItemIndex] = {}


def _blocks(items: DataFrame, item_id: str, item_text: str, letters_each: int) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for r in items.select(item_id, item_text).toLocalIterator():
        if r[0] is None or r[1] is None:
            continue
        block.append((r[0], r[1]))
        size += len(r[1])
        if size >= letters_each:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(docs: DataFrame, items: DataFrame, run: int = 20, share: float = 0.5, errors: int = 0, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """Rows (item_id, doc_id, share): documents that hold at least ``share`` of an item in passages of ``run`` letters.

    Passages may lie anywhere, in any number and order; each must be held letter by letter but for ``errors`` edits
    in a window of ``run``. Case, spacing, punctuation, markup, line breaks, invisible characters and typographic
    variants do not count. Null and empty texts hold nothing; an item of fewer than ``run`` letters cannot leak;
    repeated documents each give rows. The items (a query set) are sent to the workers in blocks of
    ``block_letters``, one pass over the corpus for each; the corpus is never shuffled, and a document is searched
    whole whatever its length.
    """
    schema = T.StructType([T.StructField("item_id", items.schema[item_id].dataType), T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("share", T.DoubleType())])
    spark, source, out = docs.sparkSession, spread(docs.select(doc_id, text)), None
    for block in _blocks(items, item_id, item_text, block_letters):
        sent, tag = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(it: Iterator[pa.RecordBatch], sent=sent, tag=tag) -> Iterator[pa.RecordBatch]:
            if tag not in _INDEX:
                _INDEX.clear()
                _INDEX[tag] = ItemIndex(sent.value, run, errors, share)
            index = _INDEX[tag]
            for batch in it:
                rows = []
                for d, t in zip(batch.column(0), batch.column(1)):
                    if (whole := t.as_py()) is not None:
                        rows += [(i, d.as_py(), x) for i, x in index.shares(whole) if x >= share]
                if rows:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_pydict({"item_id": list(cols[0]), "doc_id": list(cols[1]), "share": list(cols[2])})

        part = source.mapInArrow(search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)
