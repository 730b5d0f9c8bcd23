"""MinHash near-dedup (operator 3): fast similarity sketching, banding, exact verification.

A document's set holds the hashes of its distinct five-word shingles (A-Z in
lower case, words between ASCII white space); with fewer words, the whole
sequence is its one shingle; without words the set is empty and linked with
nothing.  Documents are linked where 100 * intersection >= 85 * union.

Sketch.  ``COORDS`` coordinates are filled in rounds: in each of the first
``COORDS`` rounds every shingle is thrown into one coordinate by a fresh hash,
carrying the round and a hash value; the smallest wins.  In each of the
following ``COORDS`` rounds one coordinate gets all shingles, so every
coordinate fills whatever the set's size.  A document takes part only until
its coordinates are full: a large set needs a few rounds.

Search.  Documents of equal sets are one class, represented by the smallest
doc_id.  Bands of ``ROWS`` coordinates are buckets of representatives.  In
each bucket every member is first verified against the smallest member (one
pair a member), which settles a bucket of true copies in linear work.  What
is left, members whose component still differs from the bucket's first, is
compared with all members in blocks of ``BLOCK``: a task gets two blocks and
returns only the links it needs to join their components, so no list of pairs
is ever made and no bucket is cut short.  Buckets chained by their members are
taken together where that deals out fewer rows than each on its own.  All comparisons use the full sets.
At the threshold a pair misses all bands with probability 8e-7.

Components come from rounds of large-star and small-star contraction on the
links between representatives, written to the shared folder each round.

Cases: null and empty texts have n_shingles 0 and stay alone; the same doc_id
on several rows is one node; null doc_ids are kept and are linked with nothing.
Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewatch.llm.common import Words, mix, rolling, run_folder, slices, stage, utf8

WIDTH = 5
BANDS, ROWS = 24, 5
COORDS = BANDS * ROWS
BLOCK = 128
SALTS = 32
LINK, OF = 85, 100  # linked where OF * intersection >= LINK * union
MATRIX_CELLS = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.iinfo(np.uint64).max
with np.errstate(over="ignore"):
    SEEDS = mix(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * GOLDEN)

_hashes = Words(xxhash.xxh3_64_intdigest)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's five-word shingles."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    ids = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    return np.unique(rolling(ids, min(WIDTH, len(ids))) + np.uint64(min(WIDTH, len(ids))))


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``COORDS`` values for each non-empty set: round in the top byte, hash below."""
    t = COORDS
    sizes = np.array([len(s) for s in sets])
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    out = np.full(len(sets) * t, EMPTY, np.uint64)
    for turn in range(2 * t):
        thrown = mix(values ^ SEEDS[turn])
        if turn < t:
            place = ((thrown >> np.uint64(40)) * np.uint64(t) >> np.uint64(24)).astype(np.int64)
        else:
            place = np.full(len(values), turn - t)
        rank = np.uint64(turn) << np.uint64(56) | thrown & np.uint64((1 << 40) - 1)
        at = owner * t + place
        np.minimum.at(out, at, rank)
        open_rows = (out.reshape(-1, t) == EMPTY).any(axis=1)
        if not open_rows.any():
            break
        stay = open_rows[owner]
        if not stay.all():
            values, owner = values[stay], owner[stay]
    return out.reshape(-1, t)


def band_hashes(rows: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of neighbouring coordinates, the band's number included."""
    h = np.tile(SEEDS[:BANDS], (len(rows), 1))
    for k in range(ROWS):
        with np.errstate(over="ignore"):
            h = mix(h * GOLDEN + rows[:, k::ROWS])
    return h.view(np.int64)


PRINTS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
                    ("bands", pa.list_(pa.int64()))])


def _fingerprints(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        ids, texts = part.column(0).to_pylist(), utf8(part.column(1))
        for at, to in slices(texts):
            sets = [shingles(t) for t in texts[at:to]]
            full = [k for k, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if full:
                for k, row in zip(full, band_hashes(sketch([sets[k] for k in full])), strict=True):
                    bands[k] = row
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[at:to], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array(bands, pa.list_(pa.int64()))], schema=PRINTS)


def _sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("items", pa.binary())])
    for part in parts:
        ids, texts = part.column(0).to_pylist(), utf8(part.column(1))
        for at, to in slices(texts):
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[at:to], pa.int64()),
                pa.array([shingles(t).tobytes() for t in texts[at:to]], pa.binary())], schema=schema)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test on two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if OF * len(small) < LINK * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return OF * both >= LINK * (len(a) + len(b) - both)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set, by products of 0/1
    matrices over a bounded range of distinct items at a time."""
    items = np.unique(np.concatenate(left + right))
    out = np.zeros((len(left), len(right)), np.int64)
    step = max(1, MATRIX_CELLS // (len(left) + len(right)))
    for at in range(0, len(items), step):
        part = items[at:at + step]
        sides = []
        for sets in (left, right):
            dense = np.zeros((len(sets), len(part)), np.float32)
            for k, s in enumerate(sets):
                lo, hi = np.searchsorted(s, part[0]), np.searchsorted(s, part[-1], "right")
                dense[k, np.searchsorted(part, s[lo:hi])] = 1
            sides.append(dense)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    return out


def _verify_pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for part in parts:
        a, b, x, y = (c.to_pylist() for c in part.columns)
        good = [k for k in range(len(a)) if linked(np.frombuffer(x[k], np.uint64), np.frombuffer(y[k], np.uint64))]
        yield pa.RecordBatch.from_arrays([pa.array([a[k] for k in good], pa.int64()),
                                          pa.array([b[k] for k in good], pa.int64())], schema=schema)


def _block_links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links that join the components of the members of two blocks (or of one with itself)."""
    sides, ids, comps, items = (table.column(n).to_pylist() for n in ("side", "id", "comp", "items"))
    sets = [np.frombuffer(x, np.uint64) for x in items]
    first = [k for k, s in enumerate(sides) if s == 0]
    second = [k for k, s in enumerate(sides) if s == 1] or first
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    found = []
    if first:
        sizes = np.array([len(s) for s in sets])
        both = overlaps([sets[k] for k in first], [sets[k] for k in second])
        union = sizes[first][:, None] + sizes[second][None, :] - both
        for i, j in np.argwhere(OF * both >= LINK * union).tolist():
            a, b = find(comps[first[i]]), find(comps[second[j]])
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((ids[first[i]], ids[second[j]]))
    return pa.table({"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())})


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """id, comp (smallest id of its component) for every id in ``links`` (a, b long).

    Large-star then small-star until no link changes; each round is a shuffle of the links
    and is written to the shared folder.  Only counts reach the driver.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), folder, f"{name}-0")
    turn = 0
    while True:
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.filter("a <> b").distinct(), folder, f"{name}-{turn}l")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
        after = stage(small.filter("a <> b").distinct(), folder, f"{name}-{turn}s")
        same = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() \
            == after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = after
        if same:
            break
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(roots)


def near_duplicates(docs: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = spark or docs.sparkSession
    folder = run_folder(spark, "near")
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    prints = stage(docs.mapInArrow(_fingerprints, "doc_id long, n_shingles long, set_id binary, bands array<long>"),
                   folder, "prints")

    # classes of equal sets, partly counted before they move
    classes = stage(prints.filter("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("members"), F.first("bands").alias("bands")), folder, "classes")
    held = classes.select("rep", F.explode("bands").alias("bucket"))
    met = held.groupBy("bucket").agg(
        F.min("rep").alias("first"), F.count("*").alias("n"), F.max("rep").alias("last"),
        F.bit_xor(F.xxhash64("rep")).alias("mark"),
        F.sum(F.xxhash64("rep").bitwiseAND(0x7FFFFFFF)).alias("total")).filter("n > 1")  # an id may lead two classes
    # bands with the same members are the same bucket
    met = met.groupBy("first", "n", "last", "mark", "total").agg(F.min("bucket").alias("bucket"))
    members = stage(held.join(met.select("bucket", "first", "n"), "bucket").select("bucket", "first", "n", "rep"),
                    folder, "members")
    involved = stage(members.select(F.col("rep").alias("id")).distinct(), folder, "involved")
    wanted = docs.join(involved, docs["doc_id"] == involved["id"], "left_semi")
    sets = stage(wanted.mapInArrow(_sets, "id long, items binary"), folder, "sets")

    pairs = members.filter("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    x, y = sets.select(F.col("id").alias("a"), F.col("items").alias("x")), sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    stars = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify_pairs, "a long, b long")
    stars = stage(stars, folder, "stars")
    comps = stage(components(stars, folder, "star"), folder, "comps")

    rest = _unsettled(members, comps, folder)
    links = stars.unionByName(_blocked(rest, sets)).unionByName(_of_one_id(prints, classes))
    final = stage(components(stage(links, folder, "links"), folder, "all"), folder, "final")

    named = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("set_id").alias("_set"), "rep", "members", F.coalesce("comp", "rep").alias("_comp"))
    return _spread(prints, named)


def _of_one_id(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """A repeated doc_id is one document with several texts: links between the representatives of the
    classes it stands in."""
    own = prints.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "set_id")
    several = own.groupBy("doc_id").agg(F.min("set_id").alias("x"), F.max("set_id").alias("y")).filter("x <> y").select(
        F.col("doc_id").alias("_several"))
    stands = own.join(several, F.col("doc_id") == F.col("_several"), "left_semi").distinct().join(
        classes.select(F.col("set_id").alias("_set"), "rep"), F.col("set_id") == F.col("_set")).select("doc_id", "rep")
    least = stands.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a < last").select(
        F.col("doc_id").alias("_id"), "a")
    return stands.join(least, F.col("doc_id") == F.col("_id")).filter("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def _spread(prints: DataFrame, named: DataFrame) -> DataFrame:
    """Give every document its class's component.  A class of several documents is dealt to
    all salts, so no class fills one task however many documents share its set."""
    def salt(column: str):
        return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")

    linkable = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    rows = prints.select("doc_id", "n_shingles", F.when(linkable, F.col("set_id")).alias("set_id"),
                         salt("doc_id").alias("_salt"))
    dealt = named.withColumn("_at", F.explode(
        F.when(F.col("members") > 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(salt("rep")))))
    joined = rows.join(dealt, (rows["set_id"] == dealt["_set"]) & (rows["_salt"] == dealt["_at"]), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("_comp", "doc_id").alias("component_id"),
                         F.coalesce(F.col("_comp") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _cost() -> Column:
    """Rows dealt out to compare side 1 with itself and with side 0."""
    return F.col("n0") * F.col("k1") + F.col("n1") * (F.col("k0") + F.col("k1"))


def _sized(rows: DataFrame) -> DataFrame:
    """Members (level, bucket, rep, comp, side) with the sizes of their bucket's sides."""
    counts = rows.groupBy("level", "bucket").agg(
        F.sum(1 - F.col("side")).alias("n0"), F.sum("side").alias("n1")).filter("n1 > 0")
    counts = counts.withColumn("k0", F.ceil(F.col("n0") / BLOCK).cast("int")).withColumn("k1", F.ceil(F.col("n1") / BLOCK).cast("int"))
    return rows.join(counts, ["level", "bucket"])


def _unsettled(members: DataFrame, comps: DataFrame, folder: str) -> DataFrame:
    """Members of the buckets in which more than one component is left.  Side 0 shares one
    component, side 1 does not; members are dealt to blocks by hash, so no order over a
    large bucket is needed.

    Buckets that overlap would compare the same members again and again, so those chained
    by members are taken as one where that deals out fewer rows; a chain that is long
    but thin stays with its buckets.  Either way every pair of a bucket is compared."""
    own = comps.select(F.col("id").alias("rep"), "comp")
    lead = comps.select(F.col("id").alias("first"), F.col("comp").alias("lead"))
    known = members.join(own, "rep", "left").join(lead, "first", "left").select(
        F.lit(0).alias("level"), "bucket", "first", "rep", F.coalesce("comp", "rep").alias("comp"),
        (F.coalesce("comp", "rep") != F.coalesce("lead", "first")).cast("int").alias("side"))
    by_bucket = stage(_sized(stage(known, folder, "known")), folder, "open")

    chains = stage(components(by_bucket.filter("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")),
                              folder, "chain"), folder, "chains").select(F.col("id").alias("rep"), F.col("comp").alias("chain"))
    chained = stage(by_bucket.join(chains, "rep"), folder, "chained")
    met = chained.select("chain", "rep", "comp").distinct()
    main = met.groupBy("chain", "comp").agg(F.count("*").alias("n")).groupBy("chain").agg(
        F.max(F.struct("n", (-F.col("comp")).alias("comp"))).alias("m")).select("chain", (-F.col("m.comp")).alias("main"))
    by_chain = _sized(met.join(main, "chain").select(
        F.lit(1).alias("level"), F.col("chain").alias("bucket"), "rep", "comp", (F.col("comp") != F.col("main")).cast("int").alias("side")))
    apart = chained.select("chain", "bucket", _cost().alias("cost")).distinct().groupBy("chain").agg(F.sum("cost").alias("apart"))
    whole = by_chain.select("bucket", _cost().alias("whole")).distinct()
    joint = stage(apart.join(whole, apart["chain"] == whole["bucket"]).filter("whole < apart").select("chain"), folder, "joint")
    columns = ("level", "bucket", "rep", "comp", "side", "k0", "k1")
    rest = chained.join(joint, "chain", "left_anti").select(*columns).unionByName(
        by_chain.join(joint.withColumnRenamed("chain", "bucket"), "bucket", "left_semi").select(*columns))
    return stage(rest.withColumn("block", F.pmod(F.xxhash64("rep"), F.when(F.col("side") == 0, F.col("k0")).otherwise(
        F.col("k1"))).cast("int")), folder, "rest")


def _blocked(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Links found by comparing every block of side 1 with every block of its bucket."""
    key = ("level", "bucket")
    ones, i, own = rest.filter("side = 1"), F.sequence(F.lit(0), F.col("k1") - 1), F.col("block")
    with_zero = rest.filter("side = 0").withColumn("other", F.explode(i)).select(
        *key, F.lit(0).alias("kind"), own.alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "rep", "comp")
    with_one = ones.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k0") - 1))).select(
        *key, F.lit(0).alias("kind"), F.col("other").alias("i"), own.alias("j"), F.lit(1).alias("side"), "rep", "comp")
    among = ones.withColumn("other", F.explode(i)).select(
        *key, F.lit(1).alias("kind"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (own > F.col("other")).cast("int").alias("side"), "rep", "comp")
    dealt = with_zero.unionByName(with_one).unionByName(among)
    full = dealt.join(sets.withColumnRenamed("id", "rep"), "rep").withColumnRenamed("rep", "id")
    return full.groupBy(*key, "kind", "i", "j").applyInArrow(_block_links, "a long, b long")
