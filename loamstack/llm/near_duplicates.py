"""Near-duplicate texts: all pairs whose sets of token n-grams have intersection over union of at least a threshold.

No pair is lost, at any step:
1. Texts become sets of 64-bit shingle hashes, block by block; texts with equal sets are one class, named by a hash of the set.
   Each block sends its distinct shingles once, with their counts, to the task of their range, which answers how many sets hold
   each. So frequencies are exact whatever the size, and a shingle of a third of all rows costs one entry a block.
2. Prefix filter: with all shingles in one order, rarest first, two sets this alike share one of the first n - ceil(t n) + 1 of
   each. Shingles of one set alone need no posting. A posting carries the set's sketch; a shingle with very many
   postings is cut into parts of bounded size, every two of which meet in their own group.
3. Bit-sliced comparison: a sketch is a row of parity bits, bit i telling whether an odd number of the set's shingles falls on i.
   One differing shingle changes one bit, so the distance of two sketches is at most the number of shingles not shared, which
   the threshold bounds for given sizes. Sketches of a group are stored as bit planes; the planes of 64 pairs a word are added by
   carry-save counters, 128 planes at a time, and words whose pairs have all passed their radius are dropped.
4. What is within its radius is settled on the sets themselves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstack.config import cut

TOKEN = re.compile(r"[A-Za-z0-9_]+")
SKETCH_BITS = 512
STEP_PLANES = 128
BLOCK = 1 << 15  # postings of one shingle that meet in one group
BLOCK_CHARS = 1 << 24  # characters of the texts whose shingles are counted together before they are sent
BATCH = 1 << 16  # postings compared at a time
COPIES = 1 << 12  # copies of one text that are paired in one group
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of tokens (runs of ASCII letters, digits and `_`)."""
    w = TOKEN.findall(text)
    m = len(w) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    x = pd.util.hash_array(np.array(w, dtype=object), categorize=False)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = (h ^ x[k : k + m]) * MIX
        h ^= h >> np.uint64(29)
    return np.unique(h)


def set_key(h: np.ndarray, text: str) -> int:
    """Name of the class of equal sets; texts without shingles are classes by their own content."""
    x = pd.util.hash_array(np.array([h.tobytes().hex() if len(h) else "text:" + text], dtype=object), categorize=False)[0]
    return int(x.view(np.int64))


def sketch(h: np.ndarray) -> bytes:
    return np.packbits((np.bincount((h & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


def prefix_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """Of a set of `n` shingles, how many of the first two sets this alike share one of."""
    return np.minimum(n, n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1)


def radius(na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """The most shingles two sets of these sizes may differ by at the threshold."""
    return np.floor((1 - threshold) / (1 + threshold) * (na + nb) + 1e-6).astype(np.int64)


# --- bit planes --------------------------------------------------------------------------------------------------------


def planes(rows: np.ndarray, spare: int = 0) -> np.ndarray:
    """Packed rows (uint8) as bit planes: word w of plane p holds bit p of the rows 64 w to 64 w + 63; `spare` words of zeros follow."""
    lanes = -(-len(rows) // 64) * 64 + 64 * spare
    x = np.zeros((lanes, rows.shape[1]), np.uint8)
    x[: len(rows)] = rows
    return np.packbits(np.ascontiguousarray(np.unpackbits(x, axis=1).T), axis=1, bitorder="little").view(np.uint64)


def _lanes(flags: np.ndarray) -> np.ndarray:
    """Booleans, padded to whole words, as words."""
    x = np.zeros(-(-len(flags) // 64) * 64, np.uint8)
    x[: len(flags)] = flags
    return np.packbits(x, bitorder="little").view(np.uint64)


def _add(counters: list[np.ndarray], more: np.ndarray) -> list[np.ndarray]:
    """Vertical counters (least weight first) with the planes `more` added by carry-save steps, three planes to two at a time."""
    out, pool, weight = [], more, 0
    while len(pool) or weight < len(counters):
        if weight < len(counters):
            pool = np.concatenate([pool, counters[weight][None]])
        carries = []
        while len(pool) > 1:
            k = len(pool) // 3
            if k:
                a, b, c, rest = pool[:k], pool[k : 2 * k], pool[2 * k : 3 * k], pool[3 * k :]
                u = a ^ b
                carries.append((a & b) | (u & c))
                pool = np.concatenate([u ^ c, rest]) if len(rest) else u ^ c
            else:
                carries.append(pool[:1] & pool[1:2])
                pool = pool[:1] ^ pool[1:2]
        out.append(pool[0])
        pool = np.concatenate(carries) if carries else more[:0]
        weight += 1
    return out


def _above(counters: list[np.ndarray], limits: list[np.ndarray]) -> np.ndarray:
    """Lanes whose counter is above their limit, compared bit by bit from the top."""
    words = len(counters[0])
    more, equal = np.zeros(words, np.uint64), ~np.zeros(words, np.uint64)
    for k in reversed(range(max(len(counters), len(limits)))):
        c = counters[k] if k < len(counters) else np.uint64(0)
        m = limits[k] if k < len(limits) else np.uint64(0)
        more |= equal & c & ~m
        equal &= ~(c ^ m)
    return more


def _within(plane, total: int, limit: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Lanes of `alive` with at most `limit` bits set in `total` planes; `plane(first, last, words)` gives planes of some words.

    After each STEP_PLANES planes the words whose lanes have all passed their limits are dropped.
    """
    out = np.zeros(len(alive), np.uint64)
    words = np.flatnonzero(alive)
    limit = np.concatenate([limit, np.zeros(len(alive) * 64 - len(limit), np.int64)])
    if len(words):
        limit = limit.reshape(-1, 64)[words].ravel()
    limits = [_lanes((limit >> k) & 1) for k in range(int(limit.max(initial=0)).bit_length())]
    alive, counters = alive[words], []
    for first in range(0, total, STEP_PLANES):
        if not len(words):
            return out
        counters = _add(counters, plane(first, min(total, first + STEP_PLANES), words))
        alive = alive & ~_above(counters, limits)
        keep = np.flatnonzero(alive)
        if len(keep) < len(words):
            words, alive, counters, limits = words[keep], alive[keep], [c[keep] for c in counters], [m[keep] for m in limits]
    out[words] = alive
    return out


def _which(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def within_radius(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """For rows of packed sketches `a` and `b` (uint8, equal shape): is the Hamming distance at most `most`?"""
    out = np.zeros(len(a), bool)
    if len(a):
        x = planes(a ^ b)
        out[_which(_within(lambda lo, hi, words: x[lo:hi, words], len(x), most, _lanes(np.ones(len(a), bool))))] = True
    return out


def near_neighbours(group: np.ndarray, part: np.ndarray, across: np.ndarray, size: np.ndarray, pos: np.ndarray, rows: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of postings of one group (`group` ascending, sizes ascending within) whose sizes, places and sketches allow `t`.

    All groups are gone through together, by the neighbour at each distance: planes are compared with themselves, moved by so many
    lanes. Groups that have no more neighbours that far are taken out as the distance doubles. `across`: only pairs of two parts.
    """
    at = np.arange(len(group))
    step, pack = 1, True
    while len(at) > step:
        if pack:
            p = planes(rows[at], spare=1)
            g, s, q = group[at], size[at], pos[at]
            least = np.ceil(2 * t / (1 + t) * s - 1e-9).astype(np.int64)
        same = g[step:] == g[:-step]
        if not same.any():
            return
        sa, sb, qa, qb = s[:-step], s[step:], q[:-step], q[step:]
        # shared shingles at most: those before the nearer place, this one, and what is left of the shorter rest
        overlap = np.minimum(qa, qb) + np.minimum(sa - qa, sb - qb)
        ok = same & (sa >= np.ceil(t * sb - 1e-9)) & (overlap >= np.ceil(t / (1 + t) * (sa + sb) - 1e-9)) & (qa <= sa - np.minimum(sa, least[:-step]))
        ok &= ~across[at[:-step]] | (part[at[:-step]] != part[at[step:]])
        if ok.any():
            off, shift = step // 64, np.uint64(step % 64)
            wide = p.shape[1] - 1

            def moved(lo: int, hi: int, words: np.ndarray, p=p, off=off, shift=shift, wide=wide) -> np.ndarray:
                x = p[lo:hi, np.minimum(words + off, wide)]
                if shift:
                    x = (x >> shift) | (p[lo:hi, np.minimum(words + off + 1, wide)] << (np.uint64(64) - shift))
                return p[lo:hi, words] ^ x

            found = _which(_within(moved, len(p), radius(sa, sb, t), _lanes(ok)))
            if len(found):
                yield at[found], at[found + step]
        step += 1
        pack = step & (step - 1) == 0
        if pack:  # groups of at most `step` postings are through
            first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            count = np.diff(np.r_[first, len(g)])
            keep = np.repeat(count > step, count)
            pack = not keep.all() or step == 1
            at = at[keep]


# --- packed sets -------------------------------------------------------------------------------------------------------

_ZIP, _UNZIP = None, None


def pack(x: np.ndarray) -> bytes:
    """Whole numbers of at least 0 as compressed byte planes."""
    global _ZIP
    _ZIP = _ZIP or zstandard.ZstdCompressor(level=1)
    x = x.astype("<u8")
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    return bytes([width]) + _ZIP.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    global _UNZIP
    _UNZIP = _UNZIP or zstandard.ZstdDecompressor()
    width = data[0]
    raw = np.frombuffer(_UNZIP.decompress(data[1:]), np.uint8).reshape(width, -1)
    x = np.zeros((raw.shape[1], 8), np.uint8)
    x[:, :width] = raw.T
    return x.view("<u8").ravel().astype(np.uint64)


def pack_sorted(x: np.ndarray) -> bytes:
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def rank_code(df: np.ndarray) -> np.ndarray:
    """Frequencies as bytes that keep their order: exact below 64, then four steps for each doubling."""
    df = df.astype(np.int64)
    return np.where(df < 64, df, np.minimum(255, 64 + np.floor(4 * np.log2(np.maximum(df, 64) / 64) + 1e-9))).astype(np.uint8)


def _pieces(sets: list[np.ndarray], bits: int, ranges: int) -> tuple[np.ndarray, list[tuple[int, bytes, bytes]]]:
    """The places of all sets' shingles among the block's distinct ones, and (range, shingles, counts) of each range that has any."""
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    keys, place, count = np.unique(flat >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
    edge = np.searchsorted(keys, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(bits - ranges.bit_length() + 1))
    return place, [(r, pack_sorted(keys[a:b]), pack(count[a:b])) for r, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if b > a]


# --- the join ----------------------------------------------------------------------------------------------------------


def _wanted_bits(wanted: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Hashes of identifiers as bits, 16 or more for each of the `count`, up to 2^26 (8 MB): fuller ones only let more rows pass."""
    power = min(26, max(16, (16 * count).bit_length()))

    def fill(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(1 << power, bool)
        for p in parts:
            bits[_slots(p["id"], power)] = True
        yield pd.DataFrame({"bits": [np.packbits(bits).tobytes()]})

    out = np.zeros(1 << (power - 3), np.uint8)
    for r in wanted.select("id").coalesce(4).mapInPandas(fill, "bits binary").toLocalIterator():
        out |= np.frombuffer(r.bits, np.uint8)
    return out, power


def _slots(ids: pd.Series, power: int) -> np.ndarray:
    return (pd.util.hash_pandas_object(ids, index=False).to_numpy() >> np.uint64(64 - power)).astype(np.int64)


class NearDuplicates:
    """The join's two results: `members(id, class)` of all rows and `links(class_a, class_b, jaccard)` between classes.

    Rows with a NULL text or identifier are left out: they are like nothing. Texts of fewer than `n` tokens have no shingles and belong to
    the class of texts equal to them. Repeated identifiers stay repeated.
    """

    def __init__(self, df: DataFrame, identifier: str = "id", text: str = "content", n: int = 5, threshold: float = 0.8):
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be above 0 and at most 1")
        self.n, self.threshold = n, threshold
        self.rows = df.select(F.col(f"`{identifier}`").alias("id"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL AND id IS NOT NULL")
        self.kind = self.rows.schema["id"].dataType.simpleString()
        scanned = cut(self._scanned())
        self.members = scanned.select("id", "class")
        # copies of a class are one in the pairing
        classes = scanned.where(F.size("seeds") > 0).dropDuplicates(["class"])
        posts = classes.select("class", F.col("id").alias("rep"), "size", "first", "sketch", "codes", F.posexplode("seeds").alias("i", "seed"))
        posts = posts.select("class", "rep", "size", (F.col("first") + F.col("i")).alias("place"), "sketch", "seed", F.get("codes", F.col("i")).alias("code"))
        self.links = cut(self._settle(self._close(posts, scanned)))

    def _scanned(self) -> DataFrame:
        """(id, class, size, sketch, first, seeds, codes) of every row; the last five only for the first row of its class in a block.

        `seeds` are the prefix shingles that other sets hold too, with the ranks of their frequencies; `first` the place of the first.
        """
        n, t, kind = self.n, self.threshold, self.kind
        tasks = int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # both follow the size for which the session's shuffles are set; shingles that fall together only add candidates
        ranges, bits = 1 << min(16, max(6, (2 * tasks).bit_length())), min(60, max(40, 36 + tasks.bit_length()))
        chars = BLOCK_CHARS
        body = f"ids array<{kind}>, at array<int>, class array<bigint>, size array<int>, sketches binary, places binary"
        schema = f"dest bigint, block bigint, mark bigint, pieces int, {body}, keys binary, codes binary, shared binary"
        columns = [x.split(" ", 1)[0] for x in schema.split(", ")]

        def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            task, number = TaskContext.get().partitionId(), 0
            for p in parts:
                ids, texts = p["id"].tolist(), p["t"].tolist()
                size = np.cumsum([len(x) for x in texts])
                for part in np.split(np.arange(len(ids)), np.searchsorted(size, np.arange(chars, size[-1] + 1, chars))) if len(ids) else []:
                    if len(part):
                        yield block((task << 32) + number, ids[part[0] : part[-1] + 1], texts[part[0] : part[-1] + 1])
                        number += 1

        def block(number: int, ids: list, texts: list[str]) -> pd.DataFrame:
            known: dict[int, int] = {}
            at, sets, keys = [], [], []
            for x in texts:
                h = shingles(x, n)
                k = set_key(h, x)
                if k not in known:
                    known[k] = len(sets)
                    sets.append(h)
                    keys.append(k)
                at.append(known[k])
            place, pieces = _pieces(sets, bits, ranges)
            sizes = np.array([len(h) for h in sets], np.int64)
            mark = int(pd.util.hash_array(np.array([np.array(keys, np.int64).tobytes().hex() + repr(ids)], dtype=object), categorize=False)[0].view(np.int64))
            starts = np.r_[0, np.cumsum(sizes)[:-1]][sizes > 0]
            gaps = np.diff(place, prepend=0)
            gaps[starts] = place[starts]  # places ascend within a set
            out = pd.DataFrame([(r, number, mark, None, None, None, None, None, None, None, k, c, None) for r, k, c in pieces] + [(-1 - number, number, mark, len(pieces), ids, at, keys, sizes.tolist(), b"".join(map(sketch, sets)), pack(gaps), None, None, None)], columns=columns)
            return out.astype({"pieces": "Int32"})

        def count(p: pd.DataFrame) -> pd.DataFrame:
            if p["keys"].isna().all():  # a block's own row
                return p
            keys = [unpack_sorted(k) for k in p["keys"]]
            every, at = np.unique(np.concatenate(keys), return_inverse=True)
            code = rank_code(np.bincount(at, weights=np.concatenate([unpack(c) for c in p["codes"]])))
            code, ends = code[at], np.cumsum([len(k) for k in keys])
            k2, c2, s2 = [], [], []
            for k, c in zip(keys, np.split(code, ends[:-1])):
                s = c > 1
                k2.append(pack_sorted(k[s]))
                c2.append(pack(c[s]))
                s2.append(len(s).to_bytes(4, "little") + np.packbits(s).tobytes())
            return p.assign(keys=k2, codes=c2, shared=s2)

        def finish(p: pd.DataFrame) -> pd.DataFrame:
            own = p["pieces"].notna()
            b, pieces = p[own].iloc[0], p[~own].sort_values("dest")
            if own.sum() != 1 or len(pieces) != b["pieces"] or p["mark"].nunique() != 1:
                raise RuntimeError("a block of texts was computed twice with different rows: write the input to a table first")
            size = np.asarray(b["size"], np.int64)
            shared = [np.unpackbits(np.frombuffer(s[4:], np.uint8))[: int.from_bytes(s[:4], "little")] for s in pieces["shared"]]
            shared = np.concatenate([*shared, np.empty(0, np.uint8)]).astype(bool)
            keys = np.concatenate([*(unpack_sorted(k) for k in pieces["keys"]), np.empty(0, np.uint64)])
            code = np.concatenate([*(unpack(c) for c in pieces["codes"]), np.empty(0, np.uint64)]).astype(np.int64)
            order = np.full(len(shared), -1, np.int64)  # of the block's shingles that others hold too, rarest first
            order[np.flatnonzero(shared)[np.lexsort((keys, code))]] = np.arange(len(keys))
            back = np.lexsort((keys, code))
            place = unpack(b["places"]).astype(np.int64)
            owner = np.repeat(np.arange(len(size)), size)
            starts = np.cumsum(size) - size
            total = np.cumsum(place)
            place = total - np.repeat(np.where(size > 0, total[np.minimum(starts, max(0, len(total) - 1))] - place[np.minimum(starts, max(0, len(place) - 1))] if len(place) else 0, 0), size)
            rank = order[place]
            key = np.sort((owner[rank >= 0] << 40) | rank[rank >= 0])
            owner, rank = key >> 40, key & ((1 << 40) - 1)
            several = np.bincount(owner, minlength=len(size))
            first = size - several  # shingles of this set alone come first and need no posting
            posted = np.maximum(0, np.minimum(several, prefix_length(size, t) - first))
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(several) - several, several)
            keep = nth < posted[owner]
            pick = back[rank[keep]]
            seeds, codes, ends = keys[pick].view(np.int64), code[pick].astype(np.int32), np.cumsum(posted)
            rows, seen = [], set()
            width = SKETCH_BITS // 8
            for i, c in zip(b["ids"], b["at"]):
                if c in seen:
                    rows.append((i, b["class"][c], None, None, None, None, None))
                else:
                    seen.add(c)
                    lo, hi = ends[c] - posted[c], ends[c]
                    rows.append((i, b["class"][c], size[c], b["sketches"][c * width : (c + 1) * width], first[c], seeds[lo:hi], codes[lo:hi]) if hi > lo else (i, b["class"][c], None, None, None, None, None))
            return pd.DataFrame(rows, columns=["id", "class", "size", "sketch", "first", "seeds", "codes"]).astype({"size": "Int32", "first": "Int32"})

        sent = self.rows.mapInPandas(scan, schema)
        answered = sent.groupBy("dest").applyInPandas(count, schema)
        return answered.groupBy("block").applyInPandas(finish, f"id {kind}, class bigint, size int, sketch binary, first int, seeds array<bigint>, codes array<int>")

    def _close(self, posts: DataFrame, scanned: DataFrame) -> DataFrame:
        """(a, b, ia, ib): pairs of classes that share a prefix shingle and whose sizes, places and sketches allow the threshold."""
        t, kind = self.threshold, self.kind
        zero = F.lit(0)
        posts = posts.withColumns({"lo": zero, "hi": zero, "part": zero})
        bound = int(rank_code(np.array([BLOCK]))[0])
        top = scanned.agg(F.max(F.array_max("codes")).alias("c")).first().c
        if top is not None and top >= bound:  # only then can a shingle have more postings than a group takes
            often = posts.where(F.col("code") >= bound).groupBy("seed").agg(F.count("*").alias("k")).where(F.col("k") > BLOCK)
            often = cut(often.select("seed", F.ceil(F.col("k") / BLOCK).cast("int").alias("parts")))
            cold = posts.join(often, "seed", "left_anti")
            hot = posts.join(often, "seed").withColumn("part", F.pmod(F.hash("class"), F.col("parts"))).withColumn("other", F.explode(F.sequence(zero, F.col("parts") - 1)))
            hot = hot.withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).select(*cold.columns)
            posts = cold.select(*cold.columns).unionByName(hot)

        def meet(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[pd.DataFrame] = []
            count = 0
            for p in parts:
                held.append(p)
                count += len(p)
                if count < BATCH:
                    continue
                x = pd.concat(held, ignore_index=True) if len(held) > 1 else p
                last = x[["seed", "lo", "hi"]].to_numpy()
                open_ = int((last != last[-1]).any(axis=1).nonzero()[0].max(initial=-1)) + 1  # the last group may go on
                held = [x.iloc[open_:].reset_index(drop=True)]
                count = len(held[0]) if open_ else 0
                if open_:
                    yield from compared(x.iloc[:open_])
            if held:
                yield from compared(pd.concat(held, ignore_index=True))

        def compared(x: pd.DataFrame) -> Iterator[pd.DataFrame]:
            if not len(x):
                return
            k = x[["seed", "lo", "hi"]].to_numpy()
            group = np.cumsum(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
            cl = x["class"].to_numpy()
            sk = np.frombuffer(b"".join(x["sketch"]), np.uint8).reshape(len(x), -1)
            ids = x["rep"]
            size, place = (x[c].to_numpy().astype(np.int64) for c in ("size", "place"))
            for a, b in near_neighbours(group, x["part"].to_numpy(), k[:, 1] != k[:, 2], size, place, sk, t):
                swap = cl[a] > cl[b]
                a, b = np.where(swap, b, a), np.where(swap, a, b)
                keep = cl[a] != cl[b]
                a, b = a[keep], b[keep]
                yield pd.DataFrame({"a": cl[a], "b": cl[b], "ia": ids.iloc[a].to_numpy(), "ib": ids.iloc[b].to_numpy()}).drop_duplicates(["a", "b"])

        posts = posts.select("seed", "lo", "hi", "part", "class", "rep", "size", "place", "sketch").repartition("seed", "lo", "hi").sortWithinPartitions("seed", "lo", "hi", "size", "class")
        return cut(posts.mapInPandas(meet, f"a long, b long, ia {kind}, ib {kind}").dropDuplicates(["a", "b"]))

    def _settle(self, close: DataFrame) -> DataFrame:
        """The links among the close pairs, by their sets; only the texts of classes that have one are looked at again."""
        t, n, spark = self.threshold, self.n, self.rows.sparkSession
        wanted = close.select(F.col("a").alias("class"), F.col("ia").alias("id")).union(close.select("b", "ib")).distinct()
        bits, power = _wanted_bits(wanted, 2 * close.count())
        there = spark.sparkContext.broadcast(bits)  # 8 MB at most

        def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in parts:
                at = _slots(p["id"], power)
                p = p[(there.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
                if len(p):
                    h = [shingles(x, n) for x in p["t"]]
                    yield pd.DataFrame({"id": p["id"], "class": [set_key(x, y) for x, y in zip(h, p["t"])], "h": [x.tobytes() for x in h]})

        held = self.rows.mapInPandas(sets, f"id {self.kind}, class long, h binary").join(wanted, ["id", "class"], "left_semi")
        held = cut(held.dropDuplicates(["class"]).select("class", "h"))

        def exact(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for p in parts:
                j = []
                for x, y in zip(p["ha"], p["hb"]):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    j.append(both / max(1, len(x) + len(y) - both))
                yield pd.DataFrame({"class_a": p["a"], "class_b": p["b"], "jaccard": j})

        ready = close.select("a", "b").join(held.select(F.col("class").alias("a"), F.col("h").alias("ha")), "a").join(held.select(F.col("class").alias("b"), F.col("h").alias("hb")), "b")
        return ready.mapInPandas(exact, "class_a long, class_b long, jaccard double").where(F.col("jaccard") >= t - 1e-12)

    def pairs(self) -> DataFrame:
        """All pairs id_a < id_b of rows of one class or of two linked ones. A class of very many copies is paired in parts."""
        m = self.members
        parts = F.ceil(F.col("k") / COPIES).cast("int")
        many = m.groupBy("class").agg(F.count("*").alias("k")).where("k > 1").select("class", parts.alias("parts"))
        inside = m.join(many, "class").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))
        inside = inside.select("class", F.col("part").alias("p"), every.alias("q"), F.col("id").alias("x")).join(inside.select("class", every.alias("p"), F.col("part").alias("q"), F.col("id").alias("y")), ["class", "p", "q"]).where("x < y").select("x", "y")
        a = self.links.join(m.select(F.col("class").alias("class_a"), F.col("id").alias("x")), "class_a")
        across = a.join(m.select(F.col("class").alias("class_b"), F.col("id").alias("y")), "class_b").where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        return inside.unionByName(across).select(F.col("x").alias("id_a"), F.col("y").alias("id_b"))

    def groups(self) -> DataFrame:
        """(id, group_id, links): each row with the least identifier of its connected group and its class's number of links.

        Classes are connected by stars: in turn each class hands its greater, then its lesser neighbours on to the least one it knows,
        so that the rounds grow with the logarithm of a group's width. Each round is written to the shared folder.
        """
        links = self.links.select(F.col("class_a").alias("u"), F.col("class_b").alias("v"))
        edges = cut(links)
        while True:
            both = edges.union(edges.select("v", "u"))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            stars = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            down = stars.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            least = down.groupBy("u").agg(F.min("v").alias("m"))
            small = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            nxt = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())
            done = nxt.exceptAll(edges).isEmpty() and edges.count() == nxt.count()
            edges = nxt
            if done:
                break
        root = self.members.join(edges.select(F.col("u").alias("class"), F.col("v").alias("root")), "class", "left").select("id", "class", F.coalesce("root", "class").alias("root"))
        label = root.groupBy("root").agg(F.min("id").alias("group_id"))
        degree = links.union(links.select("v", "u")).groupBy(F.col("u").alias("class")).agg(F.count("*").alias("links"))
        return root.join(label, "root").join(degree, "class", "left").select("id", "group_id", F.coalesce("links", F.lit(0)).alias("links"))
