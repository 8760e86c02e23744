"""Near-duplicate documents by HyperMinHash sketches.

1. Texts become sets of hashed five-word shingles. Equal sets are one class, led by
   its smallest id; only leaders go on.
2. One hash per shingle fills ``REGISTERS`` registers: the leading bits choose the
   register, which keeps the smallest rest as its leading-zero count and mantissa
   bits, 16 bits together.
3. Four registers make a band of 64 bits. Leaders that share a band meet in a bucket.
   Every member is paired with the least and the largest id of it: linear in its size.
4. The collision-corrected estimate of the sketches drops hopeless pairs; the others
   are confirmed on full sets (100 * intersection >= 75 * union).
5. Buckets that still hold several components go through a second round, in tiles of
   bounded size: every pair of different components is estimated, each member's best
   partner confirmed. Members that are still suspect of a link go through a third, in
   which pairs are confirmed on full sets where they meet. So of the pairs that share a
   band, no link between components is lost, and no list of pairs is ever made.
6. Components come from contractions of the links, in Spark throughout.

A pair at the threshold misses all 32 bands with a chance of (1 - 0.75^4)^32 = 5e-6.

Besides, a pair of a band whose estimate is four standard errors too low is not verified:
about 3e-5 of the pairs at the threshold are lost that way.

Defined results: null and empty texts have an empty set and are linked with nothing.
Rows without an id are linked with nothing, have no component and are kept. Rows that
share an id and a text are one document; rows that share an id but not the text are linked
each by its own text, each goes only if a kept row stands for that text, and all that are
their component's smallest id stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, materialize, only, shared_or_broadcast, table, without

WIDTH = 5
REGISTERS, MANTISSA = 128, 10
ROWS_PER_BAND = 4
BANDS = REGISTERS // ROWS_PER_BAND
# Similarity of a link, in hundredths.
SIMILAR = 75
# Sketches whose estimate is more than four standard errors below are hopeless.
HOPELESS = SIMILAR / 100 - 4 * (0.75 * 0.25 / REGISTERS) ** 0.5
# Members per tile, of sketches and of full sets.
TILE, SET_TILE = 512, 256

# Fixed odd multipliers that tell the places of a shingle apart.
_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
     0xA0761D6478BD642F], dtype=np.uint64,
)
_REMEMBERED = 400_000


class _Words(dict):
    """word -> 64-bit hash, remembered within bounds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    # Of bytes, lower() changes A-Z only and split() cuts at 0x20 and 0x09-0x0D only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(words) < WIDTH:
        whole = (codes * _PLACES[: len(words)]).sum(dtype=np.uint64)
        return _mix(np.array([whole + np.uint64(len(words))], dtype=np.uint64))
    n = len(codes) - WIDTH + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(WIDTH):
        total += codes[i : i + n] * _PLACES[i]
    return np.unique(_mix(total))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """16-bit registers: leading zeros of the smallest hash, then its mantissa; 0 if empty."""
    registers = np.zeros(REGISTERS, dtype=np.uint16)
    if not len(hashes):
        return registers
    bits = REGISTERS.bit_length() - 1
    # A second mix: the order of hashes must not depend on how the set is sorted.
    mixed = _mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    place = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    rest = mixed << np.uint64(bits)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, place, rest)
    filled = np.zeros(REGISTERS, dtype=bool)
    filled[place] = True
    # Exact leading zeros through the exponent of the top 53 bits.
    zeros = 53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1]
    zeros = np.minimum(zeros, 62).astype(np.uint64)
    mantissa = ((least << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    code = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa
    registers[filled] = code[filled].astype(np.uint16)
    return registers


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers that agree by chance for sets of these sizes that share nothing.

    A cell is a leading-zero count and a mantissa. The chance that the least of k
    uniform values lies in [a, b) is (1 - a)^k - (1 - b)^k, summed over the middle of
    each leading-zero class, whose cells are alike.
    """
    n, m = (np.asarray(v, dtype=float)[..., None] / REGISTERS for v in (n, m))
    z = np.arange(0, 48)
    cells = 2.0**MANTISSA
    high = 2.0**-z
    width = high / 2 / cells
    middle = high * 0.75

    def density(k):
        return k * np.exp(-np.minimum(k * middle, 700))

    return REGISTERS * (cells * density(n) * density(m) * width**2).sum(axis=-1)


def likely_pairs(a, b, n, m) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of registers that may be linked, and their estimates.

    The estimate is corrected for collisions, which only lowers it; so the plain share
    of equal registers sorts out most pairs first.
    """
    used = ((a != 0) | (b != 0)).sum(axis=-1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    kept = np.flatnonzero(same >= HOPELESS * used)
    n, m = np.broadcast_arrays(n, m)
    chance = expected_collisions(n[kept], m[kept])
    value = (same[kept] - chance) / np.maximum(used[kept] - chance, 1e-9)
    value = np.clip(value, 0, 1)
    sure = value >= HOPELESS
    return kept[sure], value[sure]


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class key and sketch of every row."""

    def work(c):
        sets = [shingles(t) for t in c["text"]]
        return {
            "doc_id": c["doc_id"],
            "n_shingles": [len(s) for s in sets],
            "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "registers": [sketch(s).tobytes() if len(s) else None for s in sets],
        }

    return map_rows(
        only(docs, "doc_id", "text"),
        "doc_id long, n_shingles long, set_key binary, registers binary",
        work,
    )


def _bucket_ids(keys: np.ndarray) -> np.ndarray:
    """Bucket of each band of rows of band keys."""
    place = np.arange(BANDS, dtype=np.uint64)
    return _mix(keys ^ _mix(place + np.uint64(1))).view(np.int64)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per band that holds anything."""
    names = ["bucket", "id", "component"]
    for batch in batches:
        if batch.num_rows:
            data = b"".join(batch.column(2).to_pylist())
            keys = np.frombuffer(data, dtype="<u8").reshape(batch.num_rows, BANDS)
            used = keys != 0
            buckets = _bucket_ids(keys)
            times = used.sum(axis=1)
            rest = [np.repeat(batch.column(i).to_numpy(zero_copy_only=False), times) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (buckets[used], *rest)], names)


def bucket_rows(leaders: DataFrame) -> DataFrame:
    """bucket, id, component of every band of every leader."""
    return leaders.select("id", "component", "registers").mapInArrow(
        _bands, "bucket long, id long, component long"
    )


def centre_pairs(leaders: DataFrame) -> DataFrame:
    """member, centre: each member with the two centres of its buckets, each pair once."""
    rows = bucket_rows(leaders)
    shared = (
        rows.groupBy("bucket")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first <> last")
    )
    shared, count = materialize(shared, "neardup-centres")
    return (
        rows.select("bucket", F.col("id").alias("member"))
        .join(shared_or_broadcast(shared, count), "bucket")
        .select("member", F.explode(F.array("first", "last")).alias("centre"))
        .where("member <> centre")
        .distinct()
    )


def promising(pairs: DataFrame, leaders: DataFrame) -> DataFrame:
    """member, centre, likely: pairs whose sizes and sketches do not rule a link out."""
    side = leaders.select("id", "n_shingles", "registers")
    sized = 100 * F.least("n", "m") >= SIMILAR * F.greatest("n", "m")
    joined = (
        pairs.join(side.toDF("centre", "n", "ra"), "centre")
        .join(side.toDF("member", "m", "rb"), "member")
        .where(sized)
        .select("member", "centre", "n", "m", "ra", "rb")
    )

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                ra, rb = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2")
                    for c in ("ra", "rb")
                )
                n, m = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m"))
                at, value = likely_pairs(ra.reshape(-1, REGISTERS), rb.reshape(-1, REGISTERS), n, m)
                found = batch.select(["member", "centre"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*found.columns, pa.array(value)], ["member", "centre", "likely"]
                )

    return joined.mapInArrow(work, "member long, centre long, likely double")


def best_per_member(pairs: DataFrame, keep: int = 2) -> DataFrame:
    """a, b: the most likely centres of each member; the second round sees to the others.

    A member has two centres per band at most, so the lists are short.
    """
    best = F.slice(F.sort_array(F.collect_list(F.struct("likely", "centre")), asc=False), 1, keep)
    flat = pairs.groupBy("member").agg(best.alias("best")).select(
        "member", F.explode("best.centre").alias("centre")
    )
    return flat.select(
        F.least("member", "centre").alias("a"), F.greatest("member", "centre").alias("b")
    )


def full_sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """id, hashes: the whole shingle sets of the documents ``ids`` (distinct), stored."""
    ids, rows = materialize(ids, "neardup-ids")
    wanted = shared_or_broadcast(ids.select(F.col("id").alias("doc_id")), rows)
    texts = only(docs, "doc_id", "text").join(wanted, "doc_id", "left_semi")

    def work(c):
        return {"id": c["doc_id"], "hashes": [shingles(t).tobytes() for t in c["text"]]}

    sets = map_rows(texts, "id long, hashes binary", work).where(F.length("hashes") > 0)
    sets, found = materialize(sets, "neardup-sets")
    if found > rows:  # rows repeat an id: each of its sets counts, equal ones once
        sets, _ = materialize(sets.distinct(), "neardup-sets")
    return sets


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets are linked."""
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= SIMILAR * (len(both) - shared)


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    pairs, count = materialize(pairs, "neardup-pairs")
    if not count:
        return pairs.select("a", "b")
    sets = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs)
    joined = (
        pairs.join(sets.toDF("a", "sa"), "a")
        .join(sets.toDF("b", "sb"), "b")
        .where(
            100 * F.least(F.length("sa"), F.length("sb"))
            >= SIMILAR * F.greatest(F.length("sa"), F.length("sb"))
        )
        .select("a", "b", "sa", "sb")
    )

    def check(batches):
        for batch in batches:
            sides = (
                [np.frombuffer(v, dtype="<u8") for v in batch.column(i).to_pylist()] for i in (2, 3)
            )
            kept = [similar(x, y) for x, y in zip(*sides, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return joined.mapInArrow(check, "a long, b long")


def components(edges: DataFrame, label: str) -> DataFrame:
    """id, component (smallest id reachable) of every id in ``edges`` (a, b).

    Contraction: every id points at the neighbour, or itself, that comes first in a
    hashed order, then at what that one points at; edges move along, and those within
    one point vanish. A hashed order leaves a share of the ids each time, for chains
    too, so few rounds are enough. Every step is a stored table; joins to few ids are
    broadcast, others are shuffles in which hot ids are split.
    """

    def stored(df):
        return materialize(df, label)

    def moved(df, column, pointers, rows):
        to = shared_or_broadcast(pointers.toDF("__from", "__to"), rows)
        at = F.coalesce("__to", column).alias(column)
        kept = [at if c == column else F.col(c) for c in df.columns]
        return df.join(to, F.col(column) == F.col("__from"), "left").select(*kept)

    result = None
    edges, count = stored(edges.where("a <> b").select("a", "b"))
    while count:
        both = edges.union(edges.select("b", "a"))
        first = F.min_by("b", F.xxhash64("b")).alias("b")
        near = both.groupBy("a").agg(first)
        nearer = F.when(F.xxhash64("b") < F.xxhash64("a"), F.col("b")).otherwise(F.col("a"))
        pointers, rows = stored(near.select("a", nearer.alias("b")))
        pointers, rows = stored(moved(pointers, "b", pointers, rows))
        result = pointers if result is None else moved(result, "b", pointers, rows)
        result, _ = stored(result)
        edges = moved(moved(edges, "a", pointers, rows), "b", pointers, rows)
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges, count = stored(edges.distinct())
    if result is None:
        return edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
    names, rows = stored(result.groupBy("b").agg(F.min("a").alias("component")))
    return moved(result, "b", names, rows).select(F.col("a").alias("id"), F.col("b").alias("component"))


def mixed_buckets(rows: DataFrame) -> tuple[DataFrame, int]:
    """Buckets of ``rows`` (bucket, id, component) that hold several components, stored.

    ``major`` is the largest component of a bucket; the ``few`` others are held against
    all members.
    """
    mixed = (
        rows.groupBy("bucket", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(F.sum("n").alias("size"), F.max("n").alias("most"),
             F.max_by("component", "n").alias("major"))
        .where("size > most")
        .select("bucket", "major", (F.col("size") - F.col("most")).alias("few"),
                F.col("size").alias("all"))
    )
    return materialize(mixed, "neardup-mixed")


def in_tiles(members: DataFrame, tile: int) -> DataFrame:
    """``members`` (with bucket, major, few, all) as pairs of tiles, keyed bucket, i, j.

    Members outside the largest component are cut into tiles ``i`` (side 0), all
    members into tiles ``j`` (side 1); a pair of tiles is the work of one group.
    """
    place = F.xxhash64("id")
    few, total = (F.ceil(F.col(c) / tile).cast("int") for c in ("few", "all"))
    kept = [F.col(c) for c in members.columns if c not in ("major", "few", "all")]
    left = members.where("component <> major").select(
        *kept, F.lit(0).alias("side"), F.pmod(place, few).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), total - 1)).alias("j"),
    )
    right = members.select(
        *kept, F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), few - 1)).alias("i"),
        F.pmod(place, total).cast("int").alias("j"),
    )
    return left.union(right)


def _numbers(group: pa.Table, *names: str) -> list[np.ndarray]:
    return [group.column(c).to_numpy().astype(np.int64) for c in names]


def _fitting(x: int, others: np.ndarray, comps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Members of another component whose size allows a link with ``x``."""
    y = others[comps[others] != comps[x]]
    small, large = np.minimum(sizes[y], sizes[x]), np.maximum(sizes[y], sizes[x])
    return y[100 * small >= SIMILAR * large]


def suspects(leaders: DataFrame) -> DataFrame:
    """bucket, id, partner: members that may be linked with another component of a bucket.

    Each comes once per pair of tiles and place in it, with its most likely partner if
    it is outside the largest component; so the rows grow with the members, not with
    the pairs.
    """
    rows = bucket_rows(leaders)
    mixed, count = mixed_buckets(rows)
    schema = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("partner", pa.int64())])
    members = rows.join(shared_or_broadcast(mixed, count), "bucket").join(
        leaders.select("id", "n_shingles", "registers"), "id"
    )
    members, _ = materialize(members, "neardup-members")

    def compare(group: pa.Table) -> pa.Table:
        ids, comps, sizes, side = _numbers(group, "id", "component", "n_shingles", "side")
        regs = np.frombuffer(b"".join(group.column("registers").to_pylist()), dtype="<u2")
        regs = regs.reshape(-1, REGISTERS)
        others = np.flatnonzero(side == 1)
        partner: dict[int, int | None] = {}
        for x in np.flatnonzero(side == 0):
            y = _fitting(x, others, comps, sizes)
            if len(y):
                at, likely = likely_pairs(regs[y], regs[x], sizes[y], sizes[x])
                if len(at):
                    for k in ids[y[at]].tolist():
                        partner.setdefault(k, None)
                    partner[int(ids[x])] = int(ids[y[at[np.argmax(likely)]]])
        bucket = [int(group.column("bucket")[0].as_py())] * len(partner)
        columns = (bucket, list(partner), list(partner.values()))
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)

    found = in_tiles(members, TILE).groupBy("bucket", "i", "j").applyInArrow(
        compare, "bucket long, id long, partner long"
    )
    return materialize(found, "neardup-suspects")[0]


def exact_links(found: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """a, b: links between components among suspects, confirmed on full sets in place.

    A pair is looked at in the first band it shares. One link per member and component
    is enough, so those after it are not looked for.
    """
    rows = found.select("bucket", "id").distinct().join(labels, "id")
    rows, _ = materialize(rows, "neardup-open")
    mixed, count = mixed_buckets(rows)
    if not count:
        return labels.sparkSession.createDataFrame([], "a long, b long")
    members = rows.join(shared_or_broadcast(mixed, count), "bucket")
    members, _ = materialize(members, "neardup-open")
    sets = full_sets(members.select("id").distinct(), docs)
    tiled = in_tiles(members.join(sets, "id"), SET_TILE)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirm(group: pa.Table) -> pa.Table:
        ids, comps, side = _numbers(group, "id", "component", "side")
        hashes = [np.frombuffer(h, dtype="<u8") for h in group.column("hashes").to_pylist()]
        sizes = np.array([len(h) for h in hashes])
        regs = np.stack([sketch(h) for h in hashes])
        keys = regs.view("<u8")
        homes = _bucket_ids(keys)
        bucket = group.column("bucket")[0].as_py()
        others = np.flatnonzero(side == 1)
        links = []
        for x in np.flatnonzero(side == 0):
            y = _fitting(x, others, comps, sizes)
            shared = (keys[y] == keys[x]) & (keys[x] != 0)
            y = y[homes[x][shared.argmax(axis=1)] == bucket]
            at, likely = likely_pairs(regs[y], regs[x], sizes[y], sizes[x])
            linked = set()
            for k in y[at[np.argsort(-likely, kind="stable")]].tolist():
                if comps[k] not in linked and similar(hashes[x], hashes[k]):
                    linked.add(comps[k])
                    links.append(sorted((int(ids[x]), int(ids[k]))))
        columns = list(zip(*links, strict=True)) if links else ([], [])
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return tiled.groupBy("bucket", "i", "j").applyInArrow(confirm, "a long, b long")


def _labelled(links: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, int]:
    """Stored components (id, component) of ``links`` and earlier ``labels`` together."""
    links, new = materialize(links, "neardup-links")
    if labels is not None:
        known = labels.select(F.col("component").alias("a"), F.col("id").alias("b"))
        if not new:
            return materialize(labels, "neardup-labels")
        links = known.union(links)
    return materialize(components(links, "neardup-star"), "neardup-labels")


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)


def told_apart(docs: DataFrame, rows: DataFrame) -> DataFrame | None:
    """doc_id, digest, node of every text of an id that has several; None where no id has.

    Nodes are numbers above all ids.
    """
    some = rows.where("doc_id IS NOT NULL").groupBy("doc_id")
    sets = some.agg(F.min("set_key").alias("least"), F.max("set_key").alias("most"))
    shared, count = materialize(sets.where("least <> most").select("doc_id"), "neardup-repeated")
    if not count:
        return None
    top = rows.agg(F.max("doc_id").alias("top")).first().top
    texts = docs.join(shared_or_broadcast(shared, count), "doc_id")
    texts = texts.select("doc_id", _digest().alias("digest")).distinct()
    node = F.lit(top + 1) + F.monotonically_increasing_id()
    return materialize(texts.withColumn("node", node), "neardup-nodes")[0]


def _decided(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """doc_id, n_shingles, component_id, kept, digest; and the nodes of repeated ids.

    ``digest`` tells texts of one id apart, and is null where an id has one text.
    """
    docs = only(docs, "doc_id", "text")
    rows, _ = materialize(sketched(docs), "neardup-sketches")
    nodes = told_apart(docs, rows)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    if nodes is None:
        found = _components_of(rows, docs).withColumn("kept", kept)
        return found.withColumn("digest", F.lit(None).cast("string")), None
    named = docs.withColumn("digest", _digest()).join(nodes, ["doc_id", "digest"], "left")
    named, _ = materialize(
        named.select(F.coalesce("node", "doc_id").alias("doc_id"), "text"), "neardup-apart"
    )
    rows, _ = materialize(sketched(named), "neardup-sketches")
    found, _ = materialize(_components_of(rows, named), "neardup-decided")
    own = nodes.select("node", "digest", F.col("doc_id").alias("own"))
    found = found.join(own, F.col("doc_id") == F.col("node"), "left")
    # The smallest id of a component, where nodes count as the ids they stand for.
    least = found.where("node IS NOT NULL").groupBy("component_id").agg(F.min("own").alias("least"))
    found = found.join(least, "component_id", "left").select(
        F.coalesce("own", "doc_id").alias("doc_id"), "n_shingles",
        F.least("component_id", "least").alias("component_id"), "digest",
    )
    return found.withColumn("kept", kept), nodes


def _components_of(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of sketched ``rows``, whose ids have one text each."""
    some = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "n_shingles", "registers")).alias("least")
    leaders, _ = materialize(
        some.groupBy("set_key")
        .agg(least)
        .select("set_key", F.col("least.doc_id").alias("id"), F.col("least.doc_id").alias("component"),
                "least.n_shingles", "least.registers"),
        "neardup-leaders",
    )
    first = confirmed(best_per_member(promising(centre_pairs(leaders), leaders)), docs)
    labels, count = _labelled(first, None)
    joined = (
        leaders.drop("component")
        .join(shared_or_broadcast(labels, count), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    found = suspects(materialize(joined, "neardup-joined")[0])
    likely = found.where("partner IS NOT NULL").select(
        F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b")
    )
    labels, count = _labelled(confirmed(likely.distinct(), docs), labels)
    named = found.select("id").distinct().join(shared_or_broadcast(labels, count), "id", "left")
    named = named.select("id", F.coalesce("component", "id").alias("component"))
    third = exact_links(found, materialize(named, "neardup-named")[0], docs)
    labels, count = _labelled(third, labels)
    homes = (
        leaders.select("set_key", "id")
        .join(shared_or_broadcast(labels, count), "id", "left")
        .select("set_key", F.coalesce("component", "id").alias("component"))
    )
    component = F.when(
        (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")
    ).otherwise(F.col("doc_id"))
    return rows.join(homes, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (``doc_id``, ``text``)."""
    return _decided(docs)[0].select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that a kept one stands for; all columns stay."""
    found, nodes = _decided(docs)
    gone, count = materialize(found.where("NOT kept").select("doc_id", "digest").distinct(), "neardup-gone")
    whole = gone.where("digest IS NULL")
    rest = without(docs, whole.select("doc_id"), count)
    if nodes is None:
        return rest
    flat = rest.toDF(*[f"c{i}" for i in range(len(rest.columns))])
    places = {name.lower(): i for i, name in reversed(list(enumerate(rest.columns)))}
    places |= {name: i for i, name in reversed(list(enumerate(rest.columns)))}
    text = F.sha2(F.coalesce(flat[f"c{places['text']}"], F.lit("")).cast("binary"), 256)
    some = gone.where("digest IS NOT NULL")
    same = (flat[f"c{places['doc_id']}"] == some["doc_id"]) & (text == some["digest"])
    return flat.join(shared_or_broadcast(some, count), same, "left_anti").toDF(*rest.columns)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
