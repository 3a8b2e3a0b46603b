"""Packing texts into containers of fixed capacity: bounded-space online best fit.

Each scan partition is packed by itself in one pass with a fixed number of open containers. Their free spaces are the bits of one
integer, so the best fit is the lowest bit at or above the wanted size; when too many are open the fullest closes. Containers
still open at a partition's end are packed once more, as whole items of known size, the greatest first, by the same rule with as
many open containers, in small groups of partitions; so only a handful stay partly filled however many partitions there are. Nothing
but sizes is kept, and no text is shuffled. Which texts share a container follows from how the input is split: the same files and
split size give the same containers, others give others, as full. Order the input first where that matters.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.config import cut

TOKENIZERS = "/opt/tokenizers"
GROUP = 32

_ENCODINGS: dict = {}


def vocabulary(folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> bytes:
    """The content of a vocabulary file (below 1 MB)."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return f.read()


def encoding(data: bytes):
    """The tokenizer of a vocabulary, built once a process."""
    import tiktoken

    name = hashlib.sha256(data).hexdigest()
    if name not in _ENCODINGS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
        # fixed value: the vocabulary's own way of cutting text into pieces
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        _ENCODINGS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[name]


def token_count(spark: SparkSession, text: Column, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> Column:
    """Tokens of each text; NULL stays NULL, the empty text has 0. The vocabulary file is read on the driver and sent to the executors."""
    data = spark.sparkContext.broadcast(vocabulary(folder, name))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoding(data.value)
        for s in parts:
            yield pd.Series([None if t is None else len(e.encode_ordinary(t)) for t in s], dtype="Int64")

    return F.pandas_udf(run, "long").asNondeterministic()(text)


class BestFit:
    """Open containers by free space. `place(size)` returns (container, position, whether it opened one)."""

    def __init__(self, capacity: int, separator: int, most_open: int):
        self.capacity, self.separator, self.most_open = capacity, separator, most_open
        self.bits, self.at, self.open, self.made = 0, {}, 0, 0
        self.count: dict[int, int] = {}

    def place(self, size: int) -> tuple[int, int]:
        need = size + self.separator
        fits = self.bits >> need
        if fits:
            free = need + (fits & -fits).bit_length() - 1
            c = self._take(free)
            self._put(c, free - need)
        else:
            c = self.made
            self.made += 1
            self.count[c] = 0
            if self.open >= self.most_open:  # the fullest closes
                self.count.pop(self._take((self.bits & -self.bits).bit_length() - 1))
            self._put(c, self.capacity - size)
        pos = self.count[c]
        self.count[c] = pos + 1
        return c, pos

    def _take(self, free: int) -> int:
        waiting = self.at[free]
        c = waiting.pop()
        if not waiting:
            del self.at[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return c

    def _put(self, c: int, free: int) -> None:
        self.at.setdefault(free, []).append(c)
        self.bits |= 1 << free
        self.open += 1

    def still_open(self) -> dict[int, int]:
        """Container -> tokens used."""
        return {c: self.capacity - free for free, cs in self.at.items() for c in cs}


def pack(sizes: DataFrame, specs: DataFrame, identifier: str = "doc_id", most_open: int = 256) -> DataFrame:
    """(spec_name, container, position, <identifier>, piece, first_token, tokens) for `sizes(<identifier>, tokens)` and each row of
    `specs(spec_name, capacity_tokens, separator_tokens)`, a table of a few rows.

    A text of more than a container's capacity is cut into pieces of full capacity and one rest; no other text is cut. Texts
    of NULL or 0 tokens take no space and are left out. Equal rows are separate items. A container is named by partition and
    number; `position` counts its texts from 0.
    """
    few = [(r.spec_name, int(r.capacity_tokens), int(r.separator_tokens or 0)) for r in specs.limit(1001).collect()]
    if len(few) > 1000:
        raise ValueError("specs holds more than 1000 containers' kinds")
    if any(c <= 0 or s < 0 for _, c, s in few):
        raise ValueError("a capacity must be positive, a separator not negative")
    kind = sizes.schema[identifier].dataType.simpleString()
    rows = sizes.where("tokens > 0").select(F.col(identifier).alias("id"), "tokens", F.spark_partition_id().alias("part"))

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fits = [BestFit(c, s, most_open) for _, c, s in few]
        part = None
        for p in parts:
            if not len(p):
                continue
            part = int(p["part"].iloc[0])
            out = []
            for i, n in zip(p["id"].tolist(), p["tokens"].tolist()):
                for (name, cap, _), fit in zip(few, fits):
                    start, piece = 0, 0
                    while n - start > 0:
                        size = min(cap, n - start)
                        c, pos = fit.place(size)
                        out.append((name, f"{part}-{c}", part, pos, i, piece, start, size, 0))
                        start, piece = start + size, piece + 1
            yield pd.DataFrame(out, columns=["spec_name", "container", "part", "position", "id", "piece", "first_token", "tokens", "used"])
        if part is not None:  # what is still open, for the second round
            out = [(name, f"{part}-{c}", part, fit.count[c], None, -1, 0, 0, used) for (name, _, _), fit in zip(few, fits) for c, used in fit.still_open().items()]
            yield pd.DataFrame(out, columns=["spec_name", "container", "part", "position", "id", "piece", "first_token", "tokens", "used"]).astype({"id": "object"})

    schema = f"spec_name string, container string, part int, position int, id {kind}, piece int, first_token long, tokens long, used long"
    placed = cut(rows.mapInPandas(first, schema))
    by = {name: (c, s) for name, c, s in few}

    def again(p: pd.DataFrame) -> pd.DataFrame:
        out = []
        for name, q in p.groupby("spec_name"):
            cap, sep = by[name]
            # of known items the greatest go first
            q = q.sort_values(["used", "container"], ascending=[False, True])
            fit, base, target = BestFit(cap, sep, most_open), {}, {}
            for c, used, held in zip(q["container"], q["used"], q["position"]):
                t, _ = fit.place(int(used))
                target.setdefault(t, c)
                out.append((name, c, target[t], base.get(t, 0)))
                base[t] = base.get(t, 0) + int(held)
        return pd.DataFrame(out, columns=["spec_name", "container", "target", "base"])

    left = placed.where("piece = -1").select("spec_name", "container", "position", "used", F.floor(F.col("part") / GROUP).alias("g"))
    moved = left.groupBy("g").applyInPandas(again, "spec_name string, container string, target string, base int").where("container <> target")
    items = placed.where("piece >= 0").join(moved, ["spec_name", "container"], "left")
    return items.select("spec_name", F.coalesce("target", "container").alias("container"), (F.col("position") + F.coalesce("base", F.lit(0))).alias("position"), F.col("id").alias(identifier), "piece", "first_token", "tokens")


def pack_texts(docs: DataFrame, specs: DataFrame, identifier: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, most_open: int = 256) -> DataFrame:
    """`pack` for texts, sizes being tokens of a public tokenizer."""
    sizes = docs.select(identifier, token_count(docs.sparkSession, F.col(text), folder).alias("tokens"))
    return pack(sizes, specs, identifier, most_open)


def violations(packed: DataFrame, sizes: DataFrame, specs: DataFrame, identifier: str = "doc_id") -> DataFrame:
    """(spec_name, texts, over_capacity, cut_needlessly, wrong_total) of each spec: the last three are 0 where the packing keeps its rules.

    Containers above their capacity (separators counted), texts in pieces that fit whole, and texts whose pieces do not add up.
    """
    s = specs.select("spec_name", "capacity_tokens", "separator_tokens")
    c = packed.groupBy("spec_name", "container").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).join(s, "spec_name")
    over = c.groupBy("spec_name").agg(F.count_if(F.col("t") + (F.col("n") - 1) * F.coalesce("separator_tokens", F.lit(0)) > F.col("capacity_tokens")).alias("over_capacity"))
    t = packed.groupBy("spec_name", identifier).agg(F.sum("tokens").alias("placed"), F.count("*").alias("pieces"), F.countDistinct("first_token").alias("starts")).join(s, "spec_name").join(sizes.where("tokens > 0").select(identifier, F.col("tokens").alias("size")), identifier, "full")
    of = t.groupBy("spec_name").agg(
        F.count("*").alias("texts"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("cut_needlessly"), F.count_if(~F.col("placed").eqNullSafe(F.col("size")) | (F.col("starts") != F.col("pieces"))).alias("wrong_total")
    )
    return of.join(over, "spec_name", "left").select("spec_name", "texts", F.coalesce("over_capacity", F.lit(0)).alias("over_capacity"), "cut_needlessly", "wrong_total")


def summary(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Containers used by each spec against the least number that could hold the tokens."""
    c = packed.groupBy("spec_name", "container").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    g = c.groupBy("spec_name").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"), F.sum("n").alias("pieces"))
    return g.join(specs.select("spec_name", "capacity_tokens"), "spec_name").select("spec_name", "containers", "tokens", "pieces", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least"), F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("fill"))
