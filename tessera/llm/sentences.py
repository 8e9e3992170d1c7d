"""Sentences of texts in many languages and scripts.

One pass over the corpus scans every text: it knows quotations, brackets, list items, empty lines and scripts without
stops, settles the stops that leave no doubt, and notes for every other one what stands around it. From these notes
Spark aggregations learn, per language and without supervision, words whose stop is followed by what cannot open a
sentence (abbreviations), pairs that keep together across a stop (collocations) and words that open sentences, by
log-likelihood ratios. Then every different open question is answered once, by joins to the learned rows, and the
answers are joined back to the documents.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import persisted, small, spread

#: Critical value of a log-likelihood ratio (chi-square, one degree of freedom, 0.001).
LLR = 10.83

# Characters by what they do.
_OPEN, _CLOSE = "([{（［｛【〔「『《〈", ")]}）］｝】〕」』》〉"
_PAIRS = dict(zip(_CLOSE, _OPEN)) | {"”": "“", "»": "«", "“": "„", "’": "‘"}
_QUOTES_OPEN, _QUOTES_CLOSE = "“«„‘‹", "”»’›"
_CLOSERS = _CLOSE + _QUOTES_CLOSE + "\"'"
_OPENERS = _OPEN + _QUOTES_OPEN + "\"'¿¡"
_BRACKETS = "([{（［｛【〔"
_FULL = "。！？．｡।॥។။።"  # end a sentence without a space after them
_STOPS = ".!?…‼⁇⁈⁉؟۔" + _FULL
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff豈-\ufaff]")
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f"  # Thai, Lao, Burmese: spaces part sentences

_EMPTY_LINE = re.compile(r"(?:\r\n|[\n\r\x0b\x0c\x85\u2028])[^\S\n\r\x0b\x0c\x85\u2028\u2029]*(?=(?:\r\n|[\n\r\x0b\x0c\x85\u2028]))|\u2029")
_LINE = re.compile(r"[^\n\r\x0b\x0c\x85\u2028]+")
_MARK = re.compile(r"\s*(?:([-*•·‣◦▪–—+])|\(?(\d{1,3}|[A-Za-z])[.)])\s+\S")
_CAND = re.compile(rf"[{re.escape(_STOPS)};\u037e]+(?:\s*[»]|[{re.escape(_CLOSERS)}])*")
_QUOTE = re.compile(rf"[{re.escape(_OPEN + _CLOSE + _QUOTES_OPEN + _QUOTES_CLOSE)}\"']")
_NUMBER = re.compile(r"\d(?:[\d.,]*\d)?")
_SPACED = re.compile(rf"(?<=[{_UNSPACED}])[^\S\n]*\n?[^\S\n]+(?=[{_UNSPACED}])|(?<=[{_UNSPACED}])\s+(?=[{_UNSPACED}])")
_SPACED_LATIN = re.compile(rf"(?<=[{_UNSPACED}])\s+(?=[A-Z][a-z]*\s+[a-z]+\s)")
#: A longer word is known by that many of its characters next to the stop, when learning as when looking up, so that
#: a text without spaces takes linear time.
_LONG = 200
_WORD = re.compile(rf"\S{{1,{_LONG}}}")
_SKIP = re.compile(rf"[\s{re.escape(_OPENERS)}]*")
_AROUND = _CLOSERS + " \t\n\r\u00a0\u202f"
_BROKEN = re.compile(r"[^\S\n\r]*[\n\r]")
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_GLUED = re.compile(r"[a-z\u00df-\u00ff)\d]{2}[.!?\u2026](?=[A-Z\u00c0-\u00de])")
_HAS_WORD = re.compile(r"\w")

_SCRIPTS = (("Deva", "\u0900", "\u097f"), ("Thai", "\u0e00", "\u0e7f"), ("Hang", "\uac00", "\ud7af"), ("Arab", "\u0600", "\u06ff"), ("Cyrl", "\u0400", "\u04ff"), ("Grek", "\u0370", "\u03ff"), ("Jpan", "\u3040", "\u30ff"), ("Hani", "\u4e00", "\u9fff"))


_LATIN = re.compile("[A-Za-z\u00c0-\u024f]")
_OF_SCRIPT = [(s, re.compile(f"[{a}-{b}]")) for s, a, b in _SCRIPTS]
_ANY_SCRIPT = re.compile("[" + "".join(f"{a}-{b}" for _, a, b in _SCRIPTS) + "]")


def script(par: str) -> str:
    """The script that a paragraph is written in, by all its letters (names may be Latin anywhere)."""
    if not _ANY_SCRIPT.search(par):
        return "Latn"
    other = {s: n for s, p in _OF_SCRIPT if (n := len(p.findall(par)))}
    if other and sum(other.values()) * 4 >= len(_LATIN.findall(par)):
        return "Jpan" if "Jpan" in other else max(other, key=other.get)
    return "Latn"


def language(lang: str | None, scr: str) -> str:
    """The key of statistics: the script, and for Latin script the language that the document is said to have."""
    if scr != "Latn":
        return scr
    code = (lang or "").strip().lower()[:2]
    return f"Latn:{code}" if code.isalpha() and code not in ("un", "ar", "hi", "zh", "ja", "ko", "th", "ru", "el") else "Latn:"


def kind(word: str) -> str:
    """A word as the statistics know it: lower case, numbers as '#'."""
    low = word.lower()
    return low if low.isalpha() else _NUMBER.sub("#", low)


def _depths(par: str) -> tuple[list[int], list[int]]:
    """Start and end of the outermost quotations and brackets that are closed within the paragraph."""
    stack: list[tuple[str, int]] = []
    opened: dict[str, list[int]] = {}  # where in the stack each character stands
    spans: list[tuple[int, int]] = []
    n = len(par)

    def last(c: str) -> int:
        return opened[c][-1] if opened.get(c) else -1

    def push(c: str, i: int) -> None:
        opened.setdefault(c, []).append(len(stack))
        stack.append((c, i))

    def close(top: int, end: int) -> None:
        spans.append((stack[top][1], end))
        for c, _ in stack[top:]:
            opened[c].pop()
        del stack[top:]

    for m in _QUOTE.finditer(par):
        c, i = m.group(), m.start()
        before, after = par[i - 1] if i else " ", par[i + 1] if i + 1 < n else " "
        if c in "\"'":
            top = last(c)
            if top >= 0 and not before.isspace() and (c == '"' or not after.isalnum()):
                close(top, i + 1)
            elif (before.isspace() or before in _OPENERS or (c == '"' and not before.isalnum())) and not after.isspace() and (c == '"' or after.isalpha()):
                if c == '"' or top < 0:
                    push(c, i)
            continue
        wants = _PAIRS.get(c)
        if wants is not None:
            top = max(last(wants), last("„")) if c == "”" else last(wants)
            if top >= 0:
                close(top, i + 1)
                continue
            if c not in _QUOTES_OPEN:
                continue
        if c in _OPEN or c in _QUOTES_OPEN and (c != "‘" or before.isspace()):
            push(c, i)
    starts, ends = [], []
    for a, b in sorted(spans):
        if not ends or a >= ends[-1]:
            starts.append(a)
            ends.append(b)
    return starts, ends


@dataclass(slots=True)
class Stop:
    """A possible end of a sentence, at depth 0: place after it, word before, word after and what that looks like."""

    end: int
    word: str
    nxt: str
    look: str  # L lower case, D digit, P punctuation, U upper case, N no case, M mixed name
    mark: str
    spaced: bool
    broken: bool  # a line break follows
    open_at_start: bool  # the stop closes a quotation that opened the sentence


def _look(par: str, at: int) -> tuple[str, str]:
    """The next word (bare) from ``at`` and how it begins."""
    m = _WORD.match(par, _SKIP.match(par, at).end())
    if not m:
        return "", "E"
    raw = m.group()
    c = raw[0]
    word = raw.rstrip(_CLOSERS + ".,;:!?…") or raw
    if c.isdigit():
        return word, "D"
    if not c.isalpha():
        return word, "S" if _HAS_WORD.search(raw) is None and not c.isascii() else "P"
    if c.islower():
        return word, "M" if any(x.isdigit() or x.isupper() for x in word) and word.isalnum() | ("-" in word) else "L"
    return word, "U" if c.isupper() else "N"


def stops(par: str, starts: list[int], ends: list[int]) -> Iterator[Stop]:
    """Possible sentence ends of a paragraph, in order; those inside quotations (``_depths``) are passed over."""
    n, begin = len(par), 0
    for m in _CAND.finditer(par):
        i, end = m.start(), m.end()
        run = m.group()
        mark = run.rstrip(_AROUND)
        k = bisect_right(starts, i) - 1
        quoted = k >= 0 and ends[k] > i
        if quoted:
            if ends[k] > end:
                continue  # the quotation goes on
            end = ends[k]
        while end < n and par[end] in _CLOSE + _QUOTES_CLOSE + "\"'":
            end += 1
        if end >= n:
            return
        c = par[end]
        spaced = c.isspace()
        first = mark[0]
        if ";" in mark or "\u037e" in mark:  # the Greek question mark
            if not (spaced and i and "\u0370" <= par[i - 1] <= "\u1fff"):
                continue
        word = par[max(0, i - _LONG) : i]
        word = "" if not word or word[-1].isspace() else word.rsplit(None, 1)[-1]
        if _GLUED.search(word):
            word = word[[*_GLUED.finditer(word)][-1].end() :]
        word = word.lstrip(_OPENERS + "-–—")
        if "://" in word or "@" in word:
            if not spaced:
                continue
            word = "://"
        nxt, look = _look(par, end)
        if look == "E":
            return
        at_start = quoted and par[starts[k]] not in _BRACKETS and not par[begin : starts[k]].strip()
        broken = spaced and _BROKEN.match(par, end) is not None
        yield Stop(end, word, nxt, look, mark, spaced, broken, at_start)
        begin = end


def _plain_stop(s: Stop) -> bool:
    return s.mark == "." and s.spaced


#: What an open question asks of the learned rows.
OPENS, LEARNED, NO_ABBREVIATION, EITHER = "opens", "learned", "no abbreviation", "either"


def verdict(s: Stop) -> bool | str:
    """Whether a stop ends a sentence, or what must be asked to know (``EITHER``: no abbreviation, or learned)."""
    mark = s.mark
    if mark[0] in _FULL or mark[-1] in _FULL:
        if s.open_at_start and s.look != "U":
            return False  # a quotation that opens a larger sentence
        return s.look != "P" or s.nxt[:1] in "-–—•"
    if s.look == "P" and s.broken and s.nxt in ("-", "–", "—", "*"):
        return True  # a lone list item after a full sentence
    if s.look == "P":
        return NO_ABBREVIATION if s.spaced and s.nxt[:1] in "•<#@*_~`[" and mark != "…" else False
    if not s.spaced:
        if _CJK.match(s.nxt[:1] or " "):
            return mark[-1] in "!?" and not s.open_at_start
        return _unspaced(s)
    if s.open_at_start and s.look in "LN":
        return False
    if s.look == "L":
        return False
    if "…" in mark or ".." in mark:
        return OPENS if s.look in "UN" else False
    if mark[-1] in "!?‼⁇⁈⁉؟۔;\u037e" or len(mark) > 1:
        return True
    return LEARNED if s.word else True


def _unspaced(s: Stop) -> bool | str:
    """A stop with the next sentence right after it ('...zone.We'): a plain word before, a capitalised one after."""
    if s.look not in "UN" or len(s.word) < 2 and not s.word.isdigit():
        return False
    if s.look == "N":
        return NO_ABBREVIATION if not s.word[-1:].isascii() and s.mark[0] != "…" and not s.open_at_start else False
    if any(x in s.word for x in "./\\@:_=") or "." in s.nxt or "_" in s.nxt or "/" in s.nxt:
        if not (s.mark[-1] in "!?"):
            return False
    bare = s.word.strip(_CLOSERS)
    if not bare or not (bare[-1].isalnum() or s.mark[-1] in "!?…"):
        return False
    return OPENS if "…" in s.mark else EITHER


def lone_letter(word: str) -> bool:
    return len(word) == 1 and word.isalpha() and word.isascii()


_DOTTED = re.compile(r"(?:\w\.)+\w")


# ---- layout ---------------------------------------------------------------------------------------------------


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """Parts between empty lines."""
    at = 0
    for m in _EMPTY_LINE.finditer(text):
        yield at, m.start()
        at = m.end()
    yield at, len(text)


def units(text: str) -> Iterator[tuple[int, int, bool]]:
    """Parts that no sentence crosses: (start, end, is a list item)."""
    for a, b in paragraphs(text):
        par = text[a:b]
        if not par or par.isspace():
            continue
        lines = [(m.start(), m.end()) for m in _LINE.finditer(par) if not m.group().isspace()]
        marks = [_MARK.match(par, x, y) for x, y in lines]
        items = _items(par, lines, marks)
        if not items:
            yield a, b, False
            continue
        cuts = [lines[i][0] for i in items]
        if lines[0][0] < cuts[0]:
            yield a, a + cuts[0], False
        for x, y in zip(cuts, [*cuts[1:], len(par)]):
            yield a + x, a + y, True


def _items(par: str, lines: list, marks: list) -> list[int]:
    """Numbers of the lines that begin list items: none, unless the part begins with an item or an item follows a
    colon, or two neighbouring lines have the same bullet or consecutive numbers."""
    at = [i for i, m in enumerate(marks) if m]
    if not at:
        return []
    if at[0] == 0:
        first = marks[0]
        if first.group(1) or len(lines) == 1 and first.group(2).isdigit():
            return [i for i in at if marks[i].group(1) == first.group(1)]
        if len(at) > 1 or first.group(2).isdigit():
            want, out = None, []
            for i in at:
                g = marks[i].group(2)
                if g and (want is None or g.isdigit() and int(g) == want or not g.isdigit()):
                    out.append(i)
                    want = int(g) + 1 if g.isdigit() else None
            return out
        return []
    head = par[lines[at[0] - 1][0] : lines[at[0] - 1][1]].rstrip()
    m = marks[at[0]]
    follows = [i for i in at if marks[i].group(1) == m.group(1)]
    if head.endswith((":", "：")) and (m.group(1) or m.group(2) in ("1", "a", "A")):
        return follows
    if m.group(1) in ("•", "‣", "▪") or len(follows) > 1 and follows[1] == follows[0] + 1 and (m.group(1) or m.group(2) == "1" and marks[follows[1]].group(2) == "2"):
        return follows
    return []


@dataclass(slots=True)
class Parsed:
    """A text cut at every place that ends a sentence, or may.

    ``cuts``: the end of what stands before a cut and the start of what stands after it (no white space between the
    two counts), and the number of its question, -1 if it is sure. ``asks``: rule, language, script, word before, word
    after, whether that is a number. ``seen``: language, word before, word after and look of every plain full stop.
    """

    first: int
    last: int
    cuts: list[tuple[int, int, int]]
    asks: list[tuple[str, str, str, str, str, bool]]
    seen: list[tuple[str, str, str, str]]


def parse(text: str | None, lang: str | None) -> Parsed | None:
    """All that one scan of a text tells; None for a null or blank one."""
    if text is None or not (stripped := text.rstrip()):
        return None
    n = len(stripped)
    out = Parsed(len(text) - len(text.lstrip()), n, [], [], [])

    def cut(at: int, ask: int) -> None:
        before, after = at, at
        while before and text[before - 1].isspace():
            before -= 1
        while after < n and text[after].isspace():
            after += 1
        out.cuts.append((before, after, ask))

    for a, b, item in units(text):
        if a > out.first:
            cut(a, -1)
        if item:
            continue
        part = text[a:b]
        scr = script(part)
        key = language(lang, scr)
        starts, ends = _depths(part)
        found: list[tuple[int, int]] = []
        for s in stops(part, starts, ends):
            w, x = kind(s.word), kind(s.nxt)
            if _plain_stop(s) and s.word:
                out.seen.append((key, w, x, s.look))
            ends_here = verdict(s)
            if ends_here is True:
                found.append((s.end, -1))
            elif ends_here:
                found.append((s.end, len(out.asks)))
                out.asks.append((ends_here, key, scr, w, x, s.look == "D"))
        if _ANY_UNSPACED.search(part):
            for m in [*_SPACED.finditer(part), *_SPACED_LATIN.finditer(part)]:
                k = bisect_right(starts, m.start()) - 1
                if k < 0 or ends[k] <= m.start():
                    found.append((m.start(), -1))
            found.sort()
        for at, ask in found:
            cut(a + at, ask)
    return out


def spans(first: int, last: int, cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sentences between cuts (end before, start after); what is empty between two cuts is none."""
    starts, ends = [first, *(b for _, b in cuts)], [*(a for a, _ in cuts), last]
    return [(x, y) for x, y in zip(starts, ends) if x < y]


# ---- learning -------------------------------------------------------------------------------------------------

_CUTS = "array<struct<before:int,after:int,ask:int>>"
_ASKS = "array<struct<rule:string,key:string,scr:string,w:string,x:string,digit:boolean>>"


def parsed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The corpus scanned once and written to the shared folder.

    Rows of ``what`` 'text' are documents (doc_id, batch, at: a key of the row; first, last, cuts, asks), rows of
    'stop' are counts (key, w, x, look, n) of full stops within a batch.
    """
    names = ["what", "doc_id", "batch", "at", "first", "last", "cuts", "asks", "key", "w", "x", "look", "n"]
    types = ["string", docs.schema[id_col].dataType.simpleString(), "long", "int", "int", "int", _CUTS, _ASKS, *["string"] * 4, "long"]
    cut_type = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("ask", pa.int32())]))
    ask_type = pa.list_(pa.struct([*((c, pa.string()) for c in ("rule", "key", "scr", "w", "x")), ("digit", pa.bool_())]))

    def lists(rows: list[list[tuple]], of: pa.DataType) -> pa.Array:
        offsets, flat = [0], []
        for r in rows:
            flat += r
            offsets.append(len(flat))
        cols = list(zip(*flat)) if flat else [[] for _ in of.value_type]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, of.value_type)], fields=list(of.value_type)))

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, rows, counts = [], [], Counter()
            for d, t, g in zip(batch.column(0), batch.column(1), batch.column(2)):
                if (one := parse(t.as_py(), g.as_py())) is not None:
                    ids.append(d.as_py())
                    rows.append(one)
                    counts.update(one.seen)
            n, m, base = len(rows), len(counts), uuid.uuid4().int & (2**63 - 1)
            keys = list(zip(*counts)) if counts else [[], [], [], []]
            empty = [[]] * m
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(["text"] * n + ["stop"] * m, pa.string()),
                    pa.array(ids + [None] * m, batch.schema.field(0).type),
                    pa.array([base] * (n + m), pa.int64()),
                    pa.array(range(n + m), pa.int32()),
                    pa.array([r.first for r in rows] + [None] * m, pa.int32()),
                    pa.array([r.last for r in rows] + [None] * m, pa.int32()),
                    lists([r.cuts for r in rows] + empty, cut_type),
                    lists([r.asks for r in rows] + empty, ask_type),
                    *[pa.array([None] * n + list(k), pa.string()) for k in keys],
                    pa.array([None] * n + list(counts.values()), pa.int64()),
                ],
                names=names,
            )

    return persisted(spread(docs.select(id_col, text, lang)).mapInArrow(scan, ", ".join(f"`{c}` {t}" for c, t in zip(names, types))), "sentences-parsed", ["what"])


def _llr(k: Column, n: Column, p0: Column | float) -> Column:
    """Log-likelihood ratio of seeing k of n against the rate p0."""
    p = p0 if isinstance(p0, Column) else F.lit(p0)
    term = lambda a, e: F.when(a > 0, a * F.ln(a / e)).otherwise(0.0)
    return 2 * (term(k, n * p) + term(n - k, n * (1 - p)))


def statistics(scanned: DataFrame) -> DataFrame:
    """Counts (key, w, x, look, n) of full stops: word before, word after, look; per language and per script."""
    raw = scanned.where("what = 'stop'").groupBy("key", "w", "x", "look").agg(F.sum("n").alias("n"))
    pooled = raw.where(F.col("key").contains(":")).withColumn("key", F.split("key", ":")[0]).groupBy("key", "w", "x", "look").agg(F.sum("n").alias("n"))
    return persisted(raw.unionByName(pooled), "stops")


def learn(stats: DataFrame) -> DataFrame:
    """Learned rows (what, key, w, x, v): 'joint' (word, end rate), 'pair', 'open' and 'seen'.

    A word is an abbreviation when its stops are followed by what cannot open a sentence (lower case, digits, marks)
    significantly more often than by chance (1 %), by words that keep to it, or hardly ever by a known opening. The rate at which its stops end
    sentences is the share of pure openings after it, relative to that after other words. For its pairs, the
    expected openings (rate times the opening's share) are weighed against the pair's own count.
    Entries need 3 stops.
    """
    can = F.col("look").isin("U", "N", "M")
    word = Window.partitionBy("key", "w")
    after = stats.where(can).groupBy("key", "x").agg(F.sum("n").alias("cx"))
    t = stats.join(after, ["key", "x"], "left")
    t = t.withColumn("c", F.sum("n").over(word)).withColumn("no", F.sum(F.when(can, 0).otherwise(F.col("n"))).over(word))
    tied = F.when(can & (F.col("cx") >= 5) & (F.col("n") >= 0.5 * F.col("cx")), F.col("n")).otherwise(0)
    t = t.withColumn("tied", F.sum(tied).over(word)).withColumn("ties", F.sum((tied > 0).cast("int")).over(word)).where("c >= 3")
    flagged = ((_llr(F.col("no"), F.col("c"), 0.01) >= LLR) & (F.col("no") >= 0.05 * F.col("c"))) | ((F.col("tied") >= 0.3 * F.col("c")) & (F.col("ties") <= 3) & (F.col("c") >= 5)) | (F.col("no") >= 0.6 * F.col("c"))
    t = persisted(t.withColumn("flagged", flagged), "stops-tested")
    opened = t.where(~F.col("flagged") & can).groupBy("key", "x").agg(F.sum("n").alias("cb"), F.countDistinct("w").alias("breadth"))
    total = opened.groupBy("key").agg(F.sum("cb").alias("tb"))
    opened = opened.join(total, "key").withColumn("pure", (F.col("breadth") >= 3) & (F.col("cb") >= 5) & ~F.col("x").contains("#"))
    opened = persisted(opened, "openings")
    base = opened.where("pure").groupBy("key").agg((F.sum("cb") / F.max("tb")).alias("pb"))
    t = t.join(opened.select("key", "x", "cb", "tb", "pure"), ["key", "x"], "left").join(base, "key", "left")
    t = t.withColumn("clean", F.sum(F.when(F.col("pure") & can, F.col("n")).otherwise(0)).over(word))
    t = t.withColumn("rate", F.least(F.lit(1.0), F.coalesce(F.col("clean") / F.col("c") / F.col("pb"), F.lit(0.0))))
    # hardly ever before a known opening: an abbreviation, whatever follows it
    closed = (F.col("rate") < 0.1) & (F.col("pb") < 1) & (F.col("c") >= 5) & (_llr(F.col("clean"), F.col("c"), F.col("pb")) >= LLR)
    t = persisted(t.withColumn("flagged", F.col("flagged") | F.coalesce(closed, F.lit(False))), "stops-judged")
    f = t.where("flagged")
    none = F.lit(None).cast("string")
    joint = f.select(F.lit("joint").alias("what"), "key", "w", none.alias("x"), F.col("rate").alias("v")).distinct()
    expected = F.col("rate") * (F.coalesce("cb", F.lit(0)) / F.coalesce("tb", F.lit(1))) * F.col("c")
    pair = f.where(can & (F.col("n") >= 3)).select(F.lit("pair").alias("what"), "key", "w", "x", ((F.col("rate") >= 0.05) & (expected > 0) & ~((F.col("n") > 2.5 * expected) & (_llr(F.col("n"), F.col("c"), F.least(expected / F.col("c"), F.lit(0.999))) >= LLR))).cast("double").alias("v"))
    # collocations across the stop of a word that otherwise ends sentences
    p_x = F.col("cb") / F.col("tb")
    free = t.where(~F.col("flagged") & can & F.col("cb").isNotNull())
    held = free.where((F.col("n") >= 5) & (F.col("n") >= 0.8 * F.col("cx")) & (F.col("n") < 0.3 * F.col("c")) & (_llr(F.col("n"), F.col("c"), p_x) >= LLR)).select(F.lit("pair").alias("what"), "key", "w", "x", F.lit(0.0).alias("v"))
    opens = opened.where((F.col("cb") >= 3) & (F.col("breadth") >= 2)).select(F.lit("open").alias("what"), "key", none.alias("w"), "x", (F.col("cb") / F.col("tb")).alias("v"))
    # a language's few stops tell less than those of the script together
    seen = t.where(~F.col("flagged") & ((F.col("c") >= 20) | ~F.col("key").contains(":"))).select(F.lit("seen").alias("what"), "key", "w", none.alias("x"), F.lit(1.0).alias("v")).distinct()
    return joint.unionByName(pair).unionByName(held).unionByName(opens).unionByName(seen)


def answers(asks: DataFrame, learned: DataFrame) -> DataFrame:
    """The questions (rule, key, scr, w, x, digit) with ``ends``: whether a stop like that ends a sentence.

    For a language and its script, the language's rows are looked up first. Learned rows are broadcast if they are
    counted to be few, else joined by shuffle; a question is a different one, whatever the number of its stops.
    """
    word = learned.where("what IN ('joint', 'seen')").groupBy("key", "w").agg(F.max(F.when(F.col("what") == "joint", F.col("v"))).alias("rate"), F.max(F.col("what") == "seen").alias("seen"))
    pair = learned.where("what = 'pair'").groupBy("key", "w", "x").agg((F.min("v") >= 0.5).alias("pair"))
    opening = learned.where("what = 'open' AND v > 0").select("key", "x", F.lit(True).alias("open")).distinct()
    out = asks
    for table, on in ((persisted(word, "words"), ["w"]), (persisted(pair, "pairs"), ["w", "x"]), (persisted(opening, "opens"), ["x"])):
        kept, values = small(table), [c for c in table.columns if c not in ("key", "w", "x")]
        for i, key in ((1, "key"), (2, "scr")):
            side = kept.select(F.col("key").alias(f"_k{i}"), *[F.col(c).alias(f"_{c}{i}") for c in on], *[F.col(c).alias(f"{c}{i}") for c in values])
            cond = F.col(key) == F.col(f"_k{i}")
            for c in on:
                cond &= F.col(c) == F.col(f"_{c}{i}")
            out = out.join(side, cond, "left").drop(f"_k{i}", *[f"_{c}{i}" for c in on])
    yes, no = F.lit(True), F.lit(False)
    opens = F.coalesce("open1", no) | F.coalesce("open2", no)
    lone = F.col("w").rlike("^[A-Za-z]$")
    abbreviation = F.when(F.col("rate1").isNotNull(), yes).when(F.col("seen1"), no).when(F.col("rate2").isNotNull(), yes).when(F.col("seen2"), no).otherwise(lone)

    def step(i: int, flagged: Column, free: Column) -> Column:
        """A language's answer, else what comes after a flagged word, or after one that it does not know."""
        met = F.when(F.col("digit"), no).when(F.col(f"open{i}"), F.col(f"rate{i}") >= 0.05).otherwise(flagged)
        return F.when(F.col(f"pair{i}").isNotNull(), F.col(f"pair{i}")).when(F.col(f"rate{i}").isNotNull(), met).when(F.col(f"seen{i}"), yes).otherwise(free)

    # initials and dotted abbreviations that were not met
    unknown = F.when(lone, no).when(F.col("w").rlike(r"(?U)^(?:\w\.)+\w$"), ~F.col("digit") & opens).otherwise(yes)
    known = step(1, step(2, no, no), step(2, no, unknown))
    ends = F.when(F.col("rule") == OPENS, opens).when(F.col("rule") == NO_ABBREVIATION, ~abbreviation).when(F.col("rule") == EITHER, ~abbreviation | known).otherwise(known)
    return out.select("rule", "key", "scr", "w", "x", "digit", ends.alias("ends"))


def sentences(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows (doc_id, start_pos, end_pos), one per sentence of every document; code points from 0, end exclusive.

    Closing quotes and brackets belong to the sentence, and no sentence ends inside a quotation or bracket that is
    part of a larger one. List items and what stands between empty lines end where they end; in scripts that do not
    mark sentence ends the writer's spaces do. Null, empty and blank texts give no rows; repeated rows give theirs
    each; other columns are ignored. The texts are read once; places and questions, not texts, are shuffled.
    """
    scanned = parsed(docs, id_col, text, lang)
    texts = scanned.where("what = 'text'").select("doc_id", "batch", "at", "first", "last", "cuts", "asks")
    asked = texts.select("batch", "at", F.posexplode("asks").alias("ask", "q")).select("batch", "at", "ask", "q.*")
    different = asked.select("rule", "key", "scr", "w", "x", "digit").distinct()
    # most stops end a sentence: those that do not go back to their documents
    held = persisted(answers(different, learn(statistics(scanned))).where("NOT ends").drop("ends"), "stops-held")
    held = asked.join(small(held), ["rule", "key", "scr", "w", "x", "digit"], "left_semi").groupBy("batch", "at").agg(F.collect_set("ask").alias("held"))
    cuts = F.when(F.col("held").isNull(), F.col("cuts")).otherwise(F.filter("cuts", lambda c: ~F.array_contains("held", c["ask"])))
    done = texts.drop("asks").join(held, ["batch", "at"], "left").select("doc_id", "first", "last", cuts.alias("cuts"))
    starts = F.concat(F.array("first"), F.transform("cuts", lambda c: c["after"]))
    ends = F.concat(F.transform("cuts", lambda c: c["before"]), F.array("last"))
    one = done.select("doc_id", F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))).alias("s"))
    return one.select("doc_id", F.col("s.a").cast("bigint").alias("start_pos"), F.col("s.b").cast("bigint").alias("end_pos")).where("start_pos < end_pos")
