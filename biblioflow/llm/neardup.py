"""Near-duplicate records by circulant MinHash (problem 2).

Words are hashed into a universe of 2**16 places. A first permutation shuffles
the places; coordinate k of the signature is the least value that a second
permutation, shifted circularly by k, gives any word of the record. Four
coordinates make a band; records that agree in a band are candidates, and the
exact Jaccard similarity of their word sets decides.

Words found in more than COMMON of all records say little about the work cited,
so signatures leave them out (the exact check does not); a record with fewer than
FEW other words is also banded on all its words. What counts as common comes from
exact counts over all records; their number is at most (mean words) / COMMON.

Two records whose other words are alike by s become candidates with probability
1 - (1 - s**ROWS)**BANDS: 0.998 at the threshold, 0.87 at 0.5.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm._graph import components
from biblioflow.llm._text import mix, word_hashes
from biblioflow.session import checkpoint, release

THRESHOLD = 0.65
COMMON = 0.005
FEW = 6
ROWS = 4
BANDS = 32
FULL = 64
UNIVERSE = 1 << 16
LOW = np.uint64((1 << 48) - 1)


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20))
    first = rng.permutation(UNIVERSE).astype(np.int64)
    second = rng.permutation(UNIVERSE).astype(np.uint16)
    return first, np.concatenate([second, second])


def _distinct_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """48-bit word hashes without repetition inside a text, sorted, and the text of each.

    Text number and hash share one 64-bit key, so one plain sort orders both. Two
    different words of a pair of records are confused with a chance of 1e-12.
    """
    hashes, docs = [], []
    for lo in range(0, len(texts), 1 << 16):
        h, counts = word_hashes(texts[lo : lo + (1 << 16)])
        doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        packed = _sorted_set(doc << np.uint64(48) | h >> np.uint64(16))
        hashes.append(packed & LOW)
        docs.append((packed >> np.uint64(48)).astype(np.int64) + lo)
    return (np.concatenate(hashes), np.concatenate(docs)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _sorted_set(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def _set_hash(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.uint64)
    if len(h):
        start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        total[doc[start]] = np.add.reduceat(mix(h ^ np.uint64(0x5BD1E9955BD1E995)), start)
    return mix(total).view(np.int64)


def signature_bands(h: np.ndarray, doc: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """(documents that have words, band keys of shape (bands, documents))."""
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    keys = np.zeros((bands, len(start)), np.uint64)
    if not len(start):
        return doc[:0], keys
    first, second = _permutations()
    at = first[(h % np.uint64(UNIVERSE)).astype(np.int64)]
    for band in range(bands):
        key = np.full(len(start), band + 1, np.uint64)
        packed = np.zeros(len(start), np.uint64)
        for r in range(rows):
            least = np.minimum.reduceat(second[at + (band * rows + r)], start)
            packed = (packed << np.uint64(16)) | least.astype(np.uint64)
            if r % 4 == 3:
                key = mix(key ^ packed)
        keys[band] = mix(key ^ packed)
    return doc[start], keys


def common_words(df: DataFrame, text: str, share: float = COMMON) -> tuple[list[int], int]:
    """(hashes of the words in more than ``share`` of all rows, number of rows), counted exactly.

    Counts are summed inside each input partition before the shuffle. The first part
    holds at most (mean words of a row) / share entries; a share of 1 gives none.
    """

    def count(batches):
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = rows = 0

        def flush():
            h = np.concatenate([p[0] for p in parts])
            c = np.concatenate([p[1] for p in parts])
            u, back = np.unique(h, return_inverse=True)
            n = np.bincount(back, weights=c).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["h", "n"])

        for batch in batches:
            rows += batch.num_rows
            h, _ = _distinct_words(batch.column(0).to_pylist())
            parts.append(np.unique(h, return_counts=True))
            held += len(parts[-1][0])
            if held > 2_000_000:
                yield flush()
                parts, held = [], 0
        parts.append((np.array([ALL], np.uint64), np.array([rows])))
        yield flush()

    counts = df.select(text).mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    counts = checkpoint(counts.where(f"n > 20 or h = {ALL}"))
    total = (counts.where(F.col("h") == ALL).first() or {"n": 0})["n"]
    limit = max(share * total, 20)
    common = sorted(r["h"] for r in counts.where((F.col("n") > limit) & (F.col("h") != ALL)).select("h").collect())
    release(counts)
    return common, total


#: Stands for all rows among the counted words, which have 48 bits.
ALL = 1 << 60
BAND, HOT = 0, 1
SMALL = 512
#: Band entries that a task holds before it hands them over, and that one group of keys has on average.
HELD = 1 << 20
KEY_BITS = 40


def _pack(keys: np.ndarray, nodes: np.ndarray) -> bytes:
    """Keys and nodes as planes of bytes, in the order of the keys: leading planes hardly vary and compress away."""
    planes = np.concatenate([keys.view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8], nodes.view(np.uint8).reshape(-1, 8)], axis=1)
    return np.ascontiguousarray(planes.T).tobytes()


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = KEY_BITS // 8
    planes = np.frombuffer(body, np.uint8).reshape(wide + 8, -1)
    keys = np.zeros((planes.shape[1], 8), np.uint8)
    keys[:, :wide] = planes[:wide].T
    return keys.view(np.uint64).reshape(-1), np.ascontiguousarray(planes[wide:].T).view(np.int64).reshape(-1)


def _bands(base: DataFrame, common: list[int], rows: int, bands: int, groups: int) -> DataFrame:
    """(part, n, body) of base(node, text): packed band keys and nodes, and pairs of copies as parts below 0.

    A band key belongs to one of ``groups`` parts by its size, so a part is a narrow
    range of keys and travels as a few packed rows instead of one row a key.
    Of records with the same hash of the word set in one input partition only the
    first is banded; every further one makes a pair with it at once, so a text that a
    third of all rows repeat enters each bucket once per partition. A task remembers
    a million such hashes; copies of what came later meet in their buckets.
    """
    known = base.sparkSession.sparkContext.broadcast(np.sort(np.array(common, np.int64).view(np.uint64)))

    def run(batches):
        seen: dict[int, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            keys, nodes = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            keys, nodes = keys[order], nodes[order]
            part = (keys * np.uint64(groups)) >> np.uint64(KEY_BITS)
            start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            stop = np.append(start[1:], len(keys))
            bodies = [_pack(keys[a:b], nodes[a:b]) for a, b in zip(start.tolist(), stop.tolist())]
            return pa.RecordBatch.from_arrays([pa.array(part[start].astype(np.int64)), pa.array(stop - start), pa.array(bodies, pa.binary())], ["part", "n", "body"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            h, doc = _distinct_words(texts)
            has = np.bincount(doc, minlength=len(texts)) > 0
            fresh = np.zeros(len(texts), bool)
            copies, firsts = [], []
            for i, (s, ok) in enumerate(zip(_set_hash(h, doc, len(texts)).tolist(), has.tolist())):
                if not ok:
                    continue
                first = seen.get(s)
                if first is None:
                    fresh[i] = True
                    if len(seen) < 1_000_000:
                        seen[s] = ids[i]
                elif first != ids[i]:
                    copies.append(ids[i])
                    firsts.append(first)
            table = known.value
            spot = np.minimum(np.searchsorted(table, h), max(len(table) - 1, 0))
            rare = fresh[doc] & ((table[spot] != h) if len(table) else True)
            few = fresh & (np.bincount(doc[rare], minlength=len(texts)) < FEW)
            for part, salt in ((rare, 0), (few[doc], FULL)):
                docs, keys = signature_bands(h[part], doc[part], rows, bands)
                held.append((mix(keys + np.uint64(salt)).reshape(-1) >> np.uint64(64 - KEY_BITS), np.tile(ids[docs], len(keys))))
                size += keys.size
            if copies:
                body = np.stack([np.array(copies, np.int64), np.array(firsts, np.int64)]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([-1 - len(copies) % groups]), pa.array([len(copies)]), pa.array([body], pa.binary())], ["part", "n", "body"])
            if size >= HELD:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return base.mapInArrow(run, "part bigint, n bigint, body binary")


def word_sets(base: DataFrame) -> DataFrame:
    """(node, words) of base(node, text): the sorted 48-bit word hashes as bytes."""

    def run(batches):
        for batch in batches:
            h, doc = _distinct_words(batch.column(1).to_pylist())
            ends = 6 * np.cumsum(np.bincount(doc, minlength=batch.num_rows))
            body = np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :6])
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            sets = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(body)])
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["node", "words"])

    return base.mapInArrow(run, "node bigint, words binary")


def _words_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit hashes, words of each row) of an Arrow column of `word_sets`."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) // 6
    lo = np.frombuffer(column.buffers()[1], np.int32)[column.offset] if len(column) else 0
    body = np.frombuffer(column.buffers()[2] or b"", np.uint8)[lo : lo + 6 * int(sizes.sum())]
    h = np.zeros((len(body) // 6, 8), np.uint8)
    h[:, :6] = body.reshape(-1, 6)
    return h.view(np.uint64).reshape(-1), sizes


def verify(pairs: DataFrame, base: DataFrame, threshold: float) -> DataFrame:
    """Pairs of nodes whose word sets share at least ``threshold`` of their union.

    Words are hashed once a record; pairs carry the sorted hashes, not the texts. A
    node with several texts links by any of them.
    """
    sets = word_sets(base)
    left = sets.select(F.col("node").alias("a"), F.col("words").alias("wa"))
    right = sets.select(F.col("node").alias("b"), F.col("words").alias("wb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb")

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, 1 << 15):
                batch = whole.slice(lo, 1 << 15)
                n = batch.num_rows
                (ha, na), (hb, nb) = _words_of(batch.column(2)), _words_of(batch.column(3))
                row = np.arange(n, dtype=np.uint64) << np.uint64(48)
                x = np.sort(np.concatenate([np.repeat(row, na) | ha, np.repeat(row, nb) | hb]))
                twice = x[1:][x[1:] == x[:-1]] >> np.uint64(48)
                shared = np.bincount(twice.astype(np.int64), minlength=n)
                ok = shared >= threshold * (na + nb - shared) - 1e-9
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, key: str, text: str, threshold: float = THRESHOLD, rows: int = ROWS, bands: int = BANDS, common: float = COMMON) -> DataFrame:
    """(key, class) for every row of a class of two or more different keys.

    Two rows are linked when the word sets of their texts share at least
    ``threshold`` of their union; classes are closed under links, and a class is
    named by its least node (an integer key itself, else the key's hash). Null and
    empty texts, texts without a word and null keys are in no class; a key delivered
    twice counts once, and links by any of its texts; other columns are not read.
    Every link, those of copies included, has passed the comparison of word sets.
    ``common=1.0`` bands all words, so that candidates depend on the similarity that
    decides and on nothing else; more ``bands`` then bring the loss below any bound.
    """
    whole = df.schema[key].dataType.typeName() in ("long", "integer", "short", "byte")
    node = F.col(key).cast("bigint") if whole else F.xxhash64(F.col(key))
    base = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(node.alias("node"), F.col(text).alias("text"))
    often, total = common_words(base, "text", common)
    # by the exact row count, so that a part is of one size however large the table
    groups = max(256, total * bands // HELD)
    banded = _bands(base, often, rows, bands, groups)
    found = checkpoint(_bucket_pairs(banded))
    comps = components(verify(found.where(F.col("kind") == BAND).select("a", "b"), base, threshold))
    hot = found.where(F.col("kind") == HOT).select(F.col("a").alias("node"), F.col("b").alias("key"))
    if not hot.isEmpty():
        comps = checkpoint(comps)
        more = checkpoint(_rest(hot, comps))
        ends = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct()
        comps = _joined(comps, verify(more, base.join(ends, "node", "left_semi"), threshold))
    release(found)
    if whole:
        return comps.select(F.col("node").cast(df.schema[key].dataType).alias(key), F.col("comp").alias("class"))
    names = df.where(F.col(key).isNotNull()).select(F.col(key), node.alias("node")).distinct()
    return names.join(comps, "node").select(key, F.col("comp").alias("class"))


def _bucket_pairs(banded: DataFrame) -> DataFrame:
    """Distinct (a, b, kind): candidate pairs, and (node, key, HOT) for the members of large buckets.

    The packed rows of a part stream through. Up to SMALL nodes of a bucket give all
    their pairs. A larger bucket gives the pairs of its first SMALL nodes and the
    pair of every other node with the first one, and is let go as soon as it is seen
    to be large, so a task holds the small buckets of one part whatever its keys;
    `_rest` looks at what a large bucket leaves open.
    """
    corners: dict[int, tuple] = {}

    def settle(keys, nodes, hubs, out, last):
        """Pairs of what is held: of all buckets at the end of a part, before that of large ones only."""
        if last:  # most keys are met once and lead nowhere
            order = np.argsort(keys, kind="stable")
            keys, nodes = keys[order], nodes[order]
            same = keys[1:] == keys[:-1]
            met = np.zeros(len(keys), bool)
            met[1:] |= same
            met[:-1] |= same
            if hubs:
                met |= np.isin(keys, np.array(list(hubs), np.uint64))
            keys, nodes = keys[met], nodes[met]
            if not len(keys):
                return keys, nodes
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])
        keys, nodes = keys[new], nodes[new]
        if hubs:
            known = np.array(sorted(hubs), np.uint64)
            spot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            late = known[spot] == keys
            out.append((np.array([hubs[k] for k in keys[late].tolist()], np.int64), nodes[late], BAND))
            out.append((nodes[late], keys[late].view(np.int64), HOT))
            keys, nodes = keys[~late], nodes[~late]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(keys)))
        for n in np.unique(size[size > (1 if last else SMALL)]).tolist():
            first = start[size == n]
            most = min(n, SMALL)
            if most not in corners:
                corners[most] = np.triu_indices(most, 1)
            i, j = corners[most]
            out.append((nodes[first[:, None] + i].reshape(-1), nodes[first[:, None] + j].reshape(-1), BAND))
            if n > SMALL:
                for f in first.tolist():
                    hubs[int(keys[f])] = int(nodes[f])
                    out.append((np.full(n - SMALL, nodes[f]), nodes[f + SMALL : f + n], BAND))
                    out.append((nodes[f : f + n], keys[f : f + n].view(np.int64), HOT))
        small = np.repeat(size <= SMALL, size)
        return keys[small], nodes[small]

    def emit(out):
        a, b = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
        kind = np.concatenate([np.full(len(x[0]), x[2], np.int8) for x in out])
        turn = (kind == BAND) & (a > b)
        a, b = np.where(turn, b, a), np.where(turn, a, b)
        keep = (a != b) | (kind == HOT)
        return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(kind[keep])], ["a", "b", "kind"])

    def run(batches):
        part, held, size, hubs = None, [], 0, {}

        def close(last):
            nonlocal held, size
            out: list = []
            if held:
                keys, nodes = (np.concatenate(x) for x in zip(*held))
                left = settle(keys, nodes, hubs, out, last)
                held = [] if last else [left]
            size = len(held[0][0]) if held else 0
            return out

        for batch in batches:
            for p, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p < 0:
                    x = np.frombuffer(body, np.int64).reshape(2, -1)
                    yield emit([(x[0], x[1], BAND)])
                    continue
                if p != part:
                    if out := close(True):
                        yield emit(out)
                    part, hubs = p, {}
                held.append(_unpack(body))
                size += len(held[-1][0])
                if size > 4 * HELD and (out := close(False)):
                    yield emit(out)
        if out := close(True):
            yield emit(out)

    ordered = banded.select("part", "body").repartition("part").sortWithinPartitions("part")
    return ordered.mapInArrow(run, "a bigint, b bigint, kind tinyint").repartition("a").distinct()


def _rest(hot: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs of large buckets, given their members (node, key), that the first look left open.

    A link inside a component changes no class, so each node outside its bucket's
    largest component meets the nodes of that bucket that lie in other components.
    """
    member = checkpoint(hot.join(comps, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp")))
    size = member.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = size.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("main"))
    open_ = member.join(main, "key").where("comp <> main").select("key", F.col("node").alias("x"), F.col("comp").alias("cx"))
    met = open_.join(member, "key").where("comp <> cx")
    return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()


def _joined(comps: DataFrame, links: DataFrame) -> DataFrame:
    """The components after further links between nodes; only what the links touch is contracted again."""
    named = links
    for end in ("a", "b"):
        of = comps.select(F.col("node").alias(end), F.col("comp").alias("_c"))
        named = named.join(of, end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    merged = checkpoint(components(named))
    to = merged.select(F.col("node").alias("comp"), F.col("comp").alias("_to"))
    old = comps.join(to, "comp", "left").select("node", F.coalesce("_to", "comp").alias("comp"))
    return old.unionByName(merged.join(comps, "node", "left_anti"))
