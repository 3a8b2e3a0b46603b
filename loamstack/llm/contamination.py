"""Evaluation passages in training texts: rare n-gram seeds find candidates, Smith-Waterman alignment scores them.

Texts are compared as words (runs of letters and digits of the visual form, without letter case), each word a 64-bit hash.
1. Every n-gram of every item goes into a bitmap, sized by their number, and up to a number of them into a sorted list; documents are
   scanned once and those with a hit are kept with their word hashes and hits.
2. For edited copies every n-gram of an item is a seed, as an edit takes away the rarest ones. For whole runs alone, of each
   window of `run` words the n-gram rarest in the corpus is the seed, so each run of that length holds at least one.
3. Documents sharing a seed with an item are candidates; the alignment of the whole document with
   the whole item gives the longest common run and the local alignment score of edited or paraphrased copies.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamstack.config import cut
from loamstack.llm.lookalike import transducer

WORD = re.compile(r"[^\W_]+")
NGRAM = 5
LEAST_BITS, MOST_BITS = 16, 29  # as powers of two: up to 64 MB
MIX = np.uint64(0x9E3779B97F4A7C15)
MOST_SEEDS = 1 << 22  # up to 32 MB
BROADCAST_BYTES = 16 << 20


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words as they read, without letter case."""
    w = WORD.findall(transducer().apply(text).lower())
    return pd.util.hash_array(np.array(w, dtype=object), categorize=False) if w else np.empty(0, np.uint64)


def ngram_hashes(words: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """Hash of the n-gram that begins at each word (fewer than n words: none)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = (h ^ words[k : k + m]) * MIX
        h ^= h >> np.uint64(29)
    return h


def _slot(h: np.ndarray, power: int) -> np.ndarray:
    return (h >> np.uint64(64 - power)).astype(np.int64)


def align(a: np.ndarray, b: np.ndarray, match: int = 2, mismatch: int = 1, gap: int = 1) -> tuple[int, int]:
    """(longest common run of words, best local alignment score) of two word sequences; one vector step a word of `a`."""
    if not len(a) or not len(b):
        return 0, 0
    n = len(b)
    steps = np.arange(n + 1, dtype=np.int32) * gap
    h, run, best, longest = np.zeros(n + 1, np.int32), np.zeros(n + 1, np.int32), 0, 0
    for x in a:
        eq = b == x
        diagonal = h[:-1] + np.where(eq, match, -mismatch)
        row = np.maximum(0, h - gap)
        row[1:] = np.maximum(row[1:], diagonal)
        # gaps along the row: the best earlier cell less its distance
        h = np.maximum(row, np.maximum.accumulate(row + steps) - steps)
        nxt = np.zeros(n + 1, np.int32)
        nxt[1:] = np.where(eq, run[:-1] + 1, 0)
        run = nxt
        best, longest = max(best, int(h.max())), max(longest, int(run.max()))
    return longest, best


def align_pairs(a: list[np.ndarray], b: list[np.ndarray], match: int = 2, mismatch: int = 1, gap: int = 1, cells: int = 1 << 16) -> list[tuple[int, int]]:
    """`align` of every pair; pairs of like length go through each vector step together, about `cells` words of `b` at a time."""
    out: list[tuple[int, int]] = [(0, 0)] * len(a)
    todo = sorted((k for k in range(len(a)) if len(a[k]) and len(b[k])), key=lambda k: len(b[k]))
    while todo:
        # the longest first: as many pairs as fit beside it
        n = len(b[todo[-1]])
        part = todo[-max(1, cells // n) :]
        del todo[-len(part) :]
        codes = np.unique(np.concatenate([x for k in part for x in (a[k], b[k])]), return_inverse=True)[1].astype(np.int32)
        x, y, at = np.full((max(len(a[k]) for k in part), len(part), 1), -1, np.int32), np.full((len(part), n), -2, np.int32), 0
        for r, k in enumerate(part):
            x[: len(a[k]), r, 0] = codes[at : at + len(a[k])]
            at += len(a[k])
            y[r, : len(b[k])] = codes[at : at + len(b[k])]
            at += len(b[k])
        steps = np.arange(n + 1, dtype=np.int32) * gap
        h, run, best, longest = np.zeros((len(part), n + 1), np.int32), np.zeros((len(part), n + 1), np.int32), np.zeros(len(part), np.int32), np.zeros(len(part), np.int32)
        for v in x:
            eq = y == v
            row = np.maximum(0, h - gap)
            row[:, 1:] = np.maximum(row[:, 1:], h[:, :-1] + eq * np.int32(match + mismatch) - mismatch)
            h = np.maximum.accumulate(row + steps, axis=1) - steps
            run[:, 1:] = (run[:, :-1] + 1) * eq
            best, longest = np.maximum(best, h.max(axis=1)), np.maximum(longest, run.max(axis=1))
        for r, k in enumerate(part):
            out[k] = int(longest[r]), int(best[r])
    return out


def _item_seeds(items: DataFrame, n: int) -> DataFrame:
    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for i, t in zip(p["item_id"], p["passage"]):
                w = word_hashes(t)
                g = ngram_hashes(w, n).view(np.int64)
                if len(g):
                    yield pd.DataFrame({"item_id": i, "pos": np.arange(len(g), dtype=np.int32), "seed": g, "words": [w.view(np.int64) if k == 0 else None for k in range(len(g))]})

    kind = items.schema["item_id"].dataType.simpleString()
    return items.where("passage IS NOT NULL").mapInPandas(scan, f"item_id {kind}, pos int, seed long, words array<long>")


def _bitmap(seeds: DataFrame) -> tuple[np.ndarray, int, np.ndarray | None]:
    """All seeds as bits, 64 or more a seed, beyond 2^MOST_BITS bits only fuller; and sorted, if there are at most MOST_SEEDS of them,
    else n-grams that only look like a seed pass and are sorted out by the join. Each of a few tasks sends one map."""
    count = seeds.count()
    power = min(MOST_BITS, max(LEAST_BITS, (64 * count).bit_length()))
    whole = count <= MOST_SEEDS

    def fill(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, held = np.zeros(1 << (power - 3), np.uint8), [np.empty(0, np.uint64)]
        for p in parts:
            x = np.unique(p["seed"].to_numpy().view(np.uint64))
            s = _slot(x, power)
            np.bitwise_or.at(bits, s >> 3, (128 >> (s & 7)).astype(np.uint8))
            if whole:
                held.append(x)
        yield pd.DataFrame({"bits": [bits.tobytes()], "seeds": [np.unique(np.concatenate(held)).tobytes()]})

    out, lists = np.zeros(1 << (power - 3), np.uint8), [np.empty(0, np.uint64)]
    for r in seeds.select("seed").coalesce(4).mapInPandas(fill, "bits binary, seeds binary").toLocalIterator():
        out |= np.frombuffer(r.bits, np.uint8)
        lists.append(np.frombuffer(r.seeds, np.uint64))
    return out, power, np.unique(np.concatenate(lists)) if whole else None


def _small(df: DataFrame, size) -> DataFrame:
    """Broadcast only after its bytes are counted (`size`: those of a row); beyond the bound the join shuffles."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("b")).first().b
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def find_leaks(docs: DataFrame, items: DataFrame, run: int = 13, n: int = NGRAM, identifier: str = "doc_id", text: str = "text", edited: bool = True) -> DataFrame:
    """(doc_id, item_id, longest_run, score, share) of every document and item (`item_id`, `passage`) that have a run of
    `run` words in common and, with `edited`, of all that share an n-gram and have an alignment worth `run` words.

    NULL or empty texts and passages, and passages of fewer than `run` words, match nothing. Repeated documents each have
    their own rows. `share`: score over the item's own best score. No document's text is sent to the driver.
    """
    spark = docs.sparkSession
    seeds = cut(_item_seeds(items.select("item_id", "passage"), n))
    bits = spark.sparkContext.broadcast(_bitmap(seeds))  # 96 MB at most
    kind = docs.schema[identifier].dataType.simpleString()

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there, power, known = bits.value
        for p in parts:
            ids, words, hits = [], [], []
            for i, t in zip(p["id"], p["t"]):
                w = word_hashes(t)
                if len(w) < run:
                    continue
                g = ngram_hashes(w, n)
                s = _slot(g, power)
                hit = g[(there[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 == 1]
                if known is not None and len(hit):
                    at = np.searchsorted(known, hit)
                    hit = hit[known[np.minimum(at, len(known) - 1)] == hit]
                if len(hit):
                    ids.append(i)
                    words.append(w.view(np.int64))
                    hits.append(np.unique(hit).view(np.int64))
            if ids:
                yield pd.DataFrame({"id": ids, "words": words, "hits": hits})

    source = docs.select(F.col(identifier).alias("id"), F.col(text).alias("t")).where("t IS NOT NULL")
    hit_docs = cut(source.mapInPandas(scan, f"id {kind}, words array<long>, hits array<long>"))
    flat = hit_docs.select("id", F.explode("hits").alias("seed"))
    if edited:
        chosen = seeds.select("item_id", "seed").distinct()
    else:
        common = flat.groupBy("seed").agg(F.count("*").alias("df"))
        counted = seeds.select("item_id", "pos", "seed").join(common, "seed", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        # the rarest n-gram of each window of `run` words; windows cut short by the passage's end are none
        span = run - n
        w = Window.partitionBy("item_id").orderBy("pos").rowsBetween(0, span)
        chosen = counted.withColumn("best", F.min(F.struct("df", "pos", "seed")).over(w)).withColumn("full", F.count("*").over(w) == span + 1).where("full AND best.df > 0").select("item_id", F.col("best.seed").alias("seed")).distinct()
    chosen = _small(cut(chosen), F.lit(32))
    pairs = flat.join(chosen, "seed").select("id", "item_id").distinct()
    whole = seeds.where("pos = 0").select("item_id", F.col("words").alias("item_words"))
    todo = pairs.join(hit_docs.select("id", "words").dropDuplicates(["id", "words"]), "id").join(_small(whole, 16 + 8 * F.size("item_words")), "item_id")

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            got = align_pairs(list(p["item_words"]), list(p["words"]))
            yield pd.DataFrame({"id": p["id"], "item_id": p["item_id"], "longest_run": [g[0] for g in got], "score": [g[1] for g in got], "share": [g[1] / (2 * len(a)) for g, a in zip(got, p["item_words"])]})

    item_kind = items.schema["item_id"].dataType.simpleString()
    scored = todo.mapInPandas(score, f"id {kind}, item_id {item_kind}, longest_run int, score int, share double")
    return scored.where((F.col("longest_run") >= run) | (F.lit(edited) & (F.col("score") >= 2 * run))).withColumnRenamed("id", identifier)
