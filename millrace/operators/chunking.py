"""Windows and packs of sentences or paragraphs whose cuts depend on earlier cuts.

One document is folded by itself in an Arrow-batched function; documents are independent. Window
ends are found by bisection in the running word counts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, paragraphs, sentences, word_count

#: A sentence that starts so may start a piece (fixed values).
TRANSITION_STARTS = frozenset("But However Thus Moreover Yet Therefore Nevertheless Still Indeed Furthermore Meanwhile Consequently And So Then Now".split())


#: Texts that are cut at a time.
TEXTS = 64


@dataclass(frozen=True)
class Windows:
    """Overlapping windows of sentences.

    A window ends once it has `target` words, or before a sentence that would take it past target * slack when it
    already has `enough` words or `enough_sentences`. Windows under `least` words go; the next starts `overlap`
    sentences before the last one's end; it stops when fewer than `tail` words are left.
    """

    target: int
    overlap: int
    slack: float
    least: float
    tail: float
    enough: float = 0
    enough_sentences: int = 0

    def spans(self, lengths: list[int]) -> list[tuple[int, int]]:
        cum = [0, *accumulate(lengths)]
        n, i, out = len(lengths), 0, []
        while i < n:
            full = bisect_left(cum, cum[i] + self.target, i + 1)
            # The first sentence that passes the slack, and the first place where a stop is allowed.
            past = bisect_right(cum, cum[i] + self.target * self.slack, i + 1) - 1
            ready = max(i + self.enough_sentences, bisect_left(cum, cum[i] + self.enough, i) if self.enough else i)
            end = min(n, full)
            if past < end:
                end = min(end, max(past, ready))
            end = max(end, i + 1)
            if cum[end] - cum[i] >= self.least:
                out.append((i, end))
            i += max(1, end - i - self.overlap)
            if i < n and cum[n] - cum[i] < self.tail:
                break
        return out


#: W6, W7 and W8 at their usual sizes.
CORPUS = Windows(target=150, overlap=2, slack=1.4, least=100, tail=70, enough=100)
RECHUNK = Windows(target=150, overlap=1, slack=1.3, least=75, tail=60, enough_sentences=2)
ORIGINALS = Windows(target=150, overlap=1, slack=1.1, least=100, tail=50, enough=100)


def overlapping(parts: Column, windows: Windows) -> Column:
    """array<struct<text, words, sentences>> of an array of sentences."""

    kind = pa.list_(pa.struct([("text", pa.string()), ("words", pa.int32()), ("sentences", pa.int32())]))
    most = TEXTS

    @F.arrow_udf("array<struct<text:string,words:int,sentences:int>>")
    def cut(cols: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def one(xs) -> list:
            xs = [] if xs is None else xs
            lengths = [len(x.split()) for x in xs]
            return [{"text": " ".join(xs[a:b]), "words": sum(lengths[a:b]), "sentences": b - a} for a, b in windows.spans(lengths)]

        # In pieces, so that few texts are Python objects at a time.
        for col in cols:
            for lo in range(0, max(1, len(col)), most):
                yield pa.array([one(xs) for xs in col.slice(lo, most).to_pylist()], kind)

    return cut(parts)


def corpus_chunks(df: DataFrame, key: str, text: str, windows: Windows = CORPUS) -> DataFrame:
    """(key, chunk_index, text, words, sentences)."""
    chunks = df.select(key, F.posexplode(overlapping(sentences(clean_text(text)), windows)).alias("chunk_index", "_c"))
    return chunks.select(key, "chunk_index", "_c.*")


def typed_chunks(df: DataFrame, key: str, text: str, kind: str, windows: Windows = ORIGINALS) -> DataFrame:
    """Windows for originals; other kinds stay whole if they have 0.7 of the least words."""
    own = corpus_chunks(df.filter(F.col(kind) == "original"), key, text, windows).select(key, F.lit("original").alias(kind), "chunk_index", "text", "words")
    rest = df.filter(F.col(kind) != "original").withColumn("words", word_count(text)).filter(F.col("words") >= 0.7 * windows.least)
    return own.unionAll(rest.select(key, kind, F.lit(0).alias("chunk_index"), F.col(text).alias("text"), "words"))


def _packs(parts: list[str], most: int) -> list[list[str]]:
    """Parts in order, a new pack before the part that would take one past `most` words."""
    out: list[list[str]] = []
    size = 0
    for p in parts:
        n = len(p.split())
        if not out or (size + n > most and out[-1]):
            out.append([])
            size = 0
        out[-1].append(p)
        size += n
    return out


def style_paragraphs(parts: Column, least: int = 100, most: int = 300) -> Column:
    """Small paragraphs gathered to `least` words (over `most`: dropped), long ones cut into packs of sentences; a short last pack goes."""

    @F.pandas_udf("array<string>")
    def fold(col: pd.Series) -> pd.Series:
        def one(xs) -> list:
            out, held = [], []
            size = lambda ys: sum(len(y.split()) for y in ys)
            for p in () if xs is None else xs:
                n = len(p.split())
                if n < least:
                    held.append(p)
                    if size(held) >= least:
                        out += [" ".join(held)] if size(held) <= most else []
                        held = []
                    continue
                held = []
                if n <= most:
                    out.append(p)
                    continue
                packs = _packs(re.split(r"(?<=[.!?]) ", p), most)
                out += [" ".join(k) for i, k in enumerate(packs) if i < len(packs) - 1 or size(k) >= least]
            return out

        return col.map(one)

    return fold(parts)


def index_chunks(text: Column | str, least: int = 30, most: int = 200, shortest: int = 10) -> Column:
    """Paragraphs of `shortest` words or more packed to `most`; longer ones cut by sentences; the last pack needs `least` words."""

    @F.pandas_udf("array<string>")
    def fold(col: pd.Series) -> pd.Series:
        def one(xs) -> list:
            out, run = [], []
            for p in [*(() if xs is None else xs), None]:
                long_ = p is not None and len(p.split()) > most
                if p is not None and not long_:
                    if len(p.split()) >= shortest:
                        run.append(p)
                    continue
                packs = _packs(run, most)
                if p is None and packs and sum(len(x.split()) for x in packs[-1]) < least:
                    packs.pop()
                out += [" ".join(k) for k in packs]
                run = []
                if long_:
                    out += [" ".join(k) for k in _packs([s for s in re.split(r"(?<=\.) ", p) if s.strip()], most)]
            return out

        return col.map(one)

    return fold(paragraphs(text))


def decomposed(parts: Column, least: int = 60, most: int = 100) -> Column:
    """Pieces of least to most words, cut before a transition where one is possible; nothing for short paragraphs."""

    @F.pandas_udf("array<string>")
    def fold(col: pd.Series) -> pd.Series:
        def one(xs) -> list:
            xs = [] if xs is None else list(xs)
            lengths = [len(x.split()) for x in xs]
            if len(xs) < 4 or sum(lengths) < least + most:
                return []
            cuts, size = [0], 0
            for i, (x, n) in enumerate(zip(xs, lengths, strict=True)):
                starts = x.split()[0].rstrip(",.:;!?") in TRANSITION_STARTS if i and x.split() else False
                if (starts and least <= size <= most) or (size + n > most and size >= least):
                    cuts.append(i)
                    size = 0
                size += n
            cuts.append(len(xs))
            pieces = list(zip(cuts, cuts[1:], strict=False))
            return [" ".join(xs[a:b]) for a, b in pieces[:-1]] + [" ".join(xs[a:b]) for a, b in pieces[-1:] if sum(lengths[a:b]) >= least]

        return col.map(one)

    return fold(parts)


def with_short_variants(df: DataFrame, key: str, text: str, least: int = 60, most: int = 100) -> DataFrame:
    """Paragraphs and their pieces."""
    pieces = df.select(key, F.explode(decomposed(sentences(text), least, most)).alias(text), F.lit("short").alias("variant"))
    return df.select(key, text, F.lit("whole").alias("variant")).unionAll(pieces)


def merged_paragraphs(parts: Column, heads: Column, least: int = 60) -> Column:
    """Paragraphs merged to `least` words, headings by themselves, a short tail joined to the one before."""

    @F.pandas_udf("array<string>")
    def fold(col: pd.Series, head: pd.Series) -> pd.Series:
        def one(xs, hs) -> list:
            blocks: list = []  # (is heading, parts)
            for x, h in zip(() if xs is None else xs, () if hs is None else hs, strict=True):
                open_ = blocks and not blocks[-1][0] and sum(len(y.split()) for y in blocks[-1][1]) < least
                if h or not open_:
                    blocks.append((bool(h), [x]))
                else:
                    blocks[-1][1].append(x)
            if len(blocks) > 1 and not blocks[-1][0] and not blocks[-2][0] and sum(len(y.split()) for y in blocks[-1][1]) < least:
                blocks[-2][1].extend(blocks.pop()[1])
            return ["\n\n".join(ps) if not h else ps[0] for h, ps in blocks]

        return pd.Series([one(x, h) for x, h in zip(col, head, strict=True)])

    return fold(parts, heads)


def calibration(df: DataFrame, key: str, text: str, n: int, most: int, least: int = 200) -> DataFrame:
    """The first n texts longer than `least` characters, cut to `most`."""
    return df.filter(F.length(text) > least).orderBy(key).limit(n).select(key, F.substring(text, 1, most).alias(text))


def spliced(primary: Column, candidates: Column, mode: str = "interleave", ratio: float = 0.3) -> Column:
    """Sentences of a paragraph blended with candidates (position, sentence, similarity), each candidate once.

    interleave: the best after their positions, max(1, int(n * ratio)); replace: those above 0.3 similarity take a
    position; append: the best at the end.
    """

    @F.pandas_udf("array<string>")
    def fold(col: pd.Series, cand: pd.Series) -> pd.Series:
        def one(xs, cs) -> list:
            xs = [] if xs is None else list(xs)
            ranked = sorted((dict(c) for c in (() if cs is None else cs)), key=lambda c: (-c["similarity"], c["position"], c["sentence"]))
            take, used, places = max(1, int(len(xs) * ratio)), set(), {}
            for c in ranked:
                if len(places) == take or (mode == "replace" and c["similarity"] <= 0.3):
                    break
                place = len(places) if mode == "append" else c["position"]
                if c["sentence"] not in used and place not in places:
                    places[place] = c["sentence"]
                    used.add(c["sentence"])
            if mode == "append":
                return xs + list(places.values())
            if mode == "replace":
                return [places.get(i, x) for i, x in enumerate(xs)]
            return [y for i, x in enumerate(xs) for y in (x, *([places[i]] if i in places else []))]

        return pd.Series([one(x, c) for x, c in zip(col, cand, strict=True)])

    return fold(primary, candidates)
