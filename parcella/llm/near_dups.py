"""Near-duplicates by MinHash with tensored banding.

A text's set holds its distinct five-word shingles (64-bit hashes). Two collections of
SIDES short sketches, PART minhashes each, are computed; every pair of a sketch of the
first with one of the second is the key of a table. SIDES ** 2 tables of 2 * PART
minhashes thus cost only 2 * SIDES * PART minhashes. At similarity 0.85 a pair of texts
shares no table with probability 0.001, at 0.9 with 0.00006.

Texts with equal sets are one class, found by a 128-bit digest of the set. Classes that
share a table are candidates, confirmed on their full sets. Not all pairs of a table are
tried. Each class is first held against the leader of each of its tables: the class that
shares most places in tables (in a group of edited copies, the least edited one). Links
are closed to components. Pairs of a table that are still apart fall into two kinds. If
both share enough shingles with the leader to be linked by these alone, they are tried.
All others, however many, must share shingles that the leader has not: they meet on the
smallest of these, as many as the prefix principle asks for. Both ways lose no pair.
A filter of 192 cheap four-bit minhashes, and the set sizes, rule out hopeless pairs
inside the join, before they are written anywhere.

Defined cases: null or wordless text has an empty set and links with nothing; fewer than
five words are one shingle; a null id is linked with nothing (its component is null);
rows that share an id are one node; ties between leaders go to the smaller id; a text of
any length is read whole, and memory in a task is linear in the longest one; an empty table
gives an empty result; other columns, whatever their names, are ignored or pass through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcella.llm.common import free_name
from parcella.sources.staging import staged

WORDS = 5
SIDES, PART = 8, 3
#: Four-bit minhashes of the filter, and how many of them may differ: 27 are expected at
#: similarity 0.85, and more than 48 come with a chance of 0.00002.
FILTER, MOST_DIFFERENT = 192, 48
#: The same for the first 48 of them, which are looked at first.
QUICK, MOST_QUICK = 48, 18
SIMILAR = (85, 100)

SIGNATURE = (
    "n_shingles long, d1 long, d2 long, a array<long>, b array<long>, bits array<long>"
)

# Seeds of the hash families.
SEED_BYTES, SEED_HASHES, SEED_FILTER = 11, 12, 13


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of all texts, one after the other.

    Words are cut from the UTF-8 bytes at ASCII white space, A-Z lower-cased. A word's
    hash is a polynomial over random values of its bytes, by prefix sums over the whole
    batch; a shingle's is a polynomial over its words' hashes.
    """
    rng = np.random.default_rng(SEED_BYTES)
    values = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    bodies = [b" " + (t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    sizes = np.array([len(b) for b in bodies], np.int64)
    data = np.frombuffer(b"".join(bodies), np.uint8)
    with np.errstate(over="ignore"):
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        inside = ~blank
        first = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
        last = np.flatnonzero(inside & np.concatenate([blank[1:], [True]]))
        # place of each byte in its word gives the power of the base
        starts = np.zeros(len(data), np.int64)
        starts[first] = first
        place = np.arange(len(data)) - np.maximum.accumulate(starts)
        longest = int((last - first).max()) + 1 if len(first) else 1
        powers = np.cumprod(np.full(longest, base, np.uint64))
        terms = np.where(inside, values[data] * powers[np.minimum(place, longest - 1)], np.uint64(0))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        words = mixed(sums[last + 1] - sums[first])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        word_bounds = np.searchsorted(first, bounds)
        counts = np.diff(word_bounds)
        rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
        for k in range(WORDS if len(rolled) else 0):
            rolled = rolled * base + words[k : len(words) - WORDS + 1 + k]
        rolled = mixed(rolled)
        out, ends = [], [0]
        for i, n in enumerate(counts):
            a = word_bounds[i]
            if n >= WORDS:
                own = np.unique(rolled[a : a + n - WORDS + 1])
            elif n:
                h = np.uint64(n)
                for w in words[a : a + n]:
                    h = h * base + w
                own = mixed(np.array([h], np.uint64))
            else:
                own = np.zeros(0, np.uint64)
            out.append(own)
            ends.append(ends[-1] + len(own))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.array(ends, np.int64)


def sliced(batch, most_bytes: int = 4 << 20):
    """Parts of an Arrow batch whose last column holds a bounded number of bytes."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy()
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def signatures(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, size and digest of the set, both collections of sketches, bit sketch."""

    def run(batches):
        import pyarrow as pa

        rng = np.random.default_rng(SEED_HASHES)
        n_hashes = 2 * SIDES * PART
        xors = rng.integers(0, 1 << 64, n_hashes, dtype=np.uint64)
        odds = rng.integers(0, 1 << 64, n_hashes, dtype=np.uint64) | np.uint64(1)
        rng = np.random.default_rng(SEED_FILTER)
        short_xors = rng.integers(0, 1 << 32, FILTER, dtype=np.uint32)
        short_odds = rng.integers(0, 1 << 32, FILTER, dtype=np.uint32) | np.uint32(1)
        for batch in batches:
            for part in sliced(batch):
                hashes, bounds = shingle_sets(part.column(1).to_pylist())
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                at = bounds[:-1][full]
                n = part.num_rows
                sketches = np.zeros((n, 2 * SIDES), np.uint64)
                digests, bits = np.zeros((n, 2), np.uint64), np.zeros((n, FILTER // 16), np.uint64)
                if len(full):
                    with np.errstate(over="ignore"):
                        digests[full, 0] = mixed(np.add.reduceat(mixed(hashes), at))
                        digests[full, 1] = np.bitwise_xor.reduceat(mixed(hashes * odds[0]), at)
                        for s in range(2 * SIDES):
                            key = np.full(len(full), np.uint64(s))
                            for k in range(s * PART, (s + 1) * PART):
                                low = np.minimum.reduceat(mixed_quick(hashes, xors[k], odds[k]), at)
                                key = mixed(key * np.uint64(31) + low)
                            sketches[full, s] = key
                        short = (hashes >> np.uint64(32)).astype(np.uint32)
                        for k in range(FILTER):
                            low = np.minimum.reduceat((short ^ short_xors[k]) * short_odds[k], at)
                            low = (low * np.uint32(0x9E3779B1)) >> np.uint32(28)
                            bits[full, k // 16] |= low.astype(np.uint64) << np.uint64(4 * (k % 16))

                def lists(x):
                    return pa.FixedSizeListArray.from_arrays(
                        pa.array(np.ascontiguousarray(x).reshape(-1).view(np.int64)), x.shape[1]
                    ).cast(pa.list_(pa.int64()))

                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(np.ascontiguousarray(digests[:, 0]).view(np.int64)),
                        pa.array(np.ascontiguousarray(digests[:, 1]).view(np.int64)),
                        lists(sketches[:, :SIDES]),
                        lists(sketches[:, SIDES:]),
                        lists(bits),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "a", "b", "bits"],
                )

    chosen = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    return chosen.mapInArrow(run, f"doc_id long, {SIGNATURE}")


def mixed_quick(h: np.ndarray, x: np.uint64, odd: np.uint64) -> np.ndarray:
    """One member of the minhash family."""
    y = (h ^ x) * odd
    return y ^ (y >> np.uint64(32))


def compared(pairs: DataFrame, docs: DataFrame, id_col: str, text: str, owns: bool = False) -> DataFrame:
    """The pairs ``a, b``, whether their full sets ``links`` them, how many shingles they
    have in ``common`` (null if an id stands for two texts), and, if asked for, the
    shingles that ``a`` alone ``owns``: the smallest ones, as many as a class that is
    linked with ``a``, but not through shingles of ``b``, must have one of.

    Only texts that occur in a pair are read on; both meet at the pair and are compared
    in the Arrow batch.
    """
    top, bottom = SIMILAR

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            links = np.zeros(batch.num_rows, bool)
            common = np.zeros(batch.num_rows, np.int64)
            alone: list = [None] * batch.num_rows
            known: dict = {}
            size = 0
            for i in range(batch.num_rows):
                sets = []
                for key, value in ((batch.column(0)[i].as_py(), left[i]), (batch.column(1)[i].as_py(), right[i])):
                    body = value.as_py()
                    mark = (key, len(body or ""))
                    if mark not in known:
                        if size > 16 << 20:
                            known, size = {}, 0
                        known[mark] = shingle_sets([body])[0], body
                        size += 20 * len(body or "")
                    own, whose = known[mark]
                    if whose != body:  # another row with the same id and length
                        own = shingle_sets([body])[0]
                    sets.append(own)
                both = len(np.intersect1d(*sets, assume_unique=True))
                union = len(sets[0]) + len(sets[1]) - both
                links[i] = union > 0 and bottom * both >= top * union
                common[i] = both
                if owns:
                    n = len(sets[0])
                    needed = max(1, -(-top * n // bottom) - both)
                    rest = np.setdiff1d(sets[0], sets[1], assume_unique=True)  # in order
                    alone[i] = rest[: max(0, len(rest) - needed + 1)].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(links), pa.array(common),
                    pa.array(alone, pa.list_(pa.int64())),
                ],
                names=["a", "b", "links", "common", "owns"],
            )

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    named = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = staged(texts.join(named, "id", "left_semi"), "pair-texts")
    joined = (
        pairs.join(texts.withColumnRenamed("t", "ta"), F.col("a") == F.col("id"))
        .drop("id")
        .join(texts.withColumnRenamed("t", "tb"), F.col("b") == F.col("id"))
        .select("a", "b", "ta", "tb")
    )
    tested = joined.mapInArrow(run, "a long, b long, links boolean, common long, owns array<long>")
    return tested.groupBy("a", "b").agg(
        F.max("links").alias("links"),
        F.when(F.count(F.lit(1)) == 1, F.min("common")).alias("common"),
        F.min("owns").alias("owns"),
    )


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of undirected links ``a, b``.

    Large-star and small-star steps: each node's larger neighbours, then its smaller ones,
    are tied to its smallest. Links only get fewer and end as stars; each step is written
    out, and nothing but two sums comes to the driver.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = staged(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if now == before or now[0] == 0:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """``rows`` with the component of ``node``; itself where it has no link."""
    if found is None:
        return rows.withColumn("component", F.col("node"))
    named = found.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    return (
        rows.join(named, F.col("node") == F.col("_node"), "left")
        .withColumn("component", F.coalesce("_component", "node"))
        .drop("_node", "_component")
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    signed = staged(signatures(docs, id_col, text), "signatures")
    classes = staged(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("d1", "d2", "n_shingles")
        .agg(
            F.min("doc_id").alias("node"),
            F.min(F.struct("a", "b", "bits")).alias("x"),
        )
        .select("d1", "d2", "n_shingles", "node", "x.*"),
        "classes",
    )
    tables = classes.select(
        "node",
        F.posexplode("a").alias("i", "x"),
        "b",
    ).select("node", "i", "x", F.posexplode("b").alias("j", "y")).select(
        F.xxhash64("i", "x", "j", "y").alias("key"), "node"
    )
    shared = tables.groupBy("key").agg(
        F.min("node").alias("low"), F.max("node").alias("high")
    ).where("low < high")
    members = tables.join(shared.select("key"), "key", "left_semi")
    sketch = classes.select("node", F.struct("n_shingles", "bits").alias("sketch"))
    members = staged(members.join(sketch, "node"), "members")
    lead = staged(leaders(members), "leaders")
    held = members.join(lead, "key")
    first = held.where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    tested = staged(compared(staged(first.distinct(), "pairs"), docs, id_col, text, owns=True), "tested")
    links = tested.where("links").select("a", "b")
    found = staged(components(links), "components")
    # tables that hold one component only are done with
    now = labelled(held, found)
    apart = (
        now.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
    )
    shares = tested.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "common")
    now = staged(
        now.join(apart.select("key"), "key", "left_semi")
        .join(shares, (F.col("node") == F.col("_a")) & (F.col("lead") == F.col("_b")), "left")
        .drop("_a", "_b"),
        "open",
    )
    pairs = staged(alike(tried_by_leader(now), by_leader=True), "pairs")
    short = F.struct("sketch.n_shingles", F.slice("sketch.bits", 1, QUICK // 16).alias("bits"))
    owned = now.select("lead", "node", "component", short.alias("sketch")).distinct().join(
        tested.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "owns"),
        (F.col("node") == F.col("_a")) & (F.col("lead") == F.col("_b")),
    )
    met = alike(
        owned.select(
            "lead", "node", "component", "sketch", F.explode("owns").alias("own")
        ).withColumn("key", F.xxhash64("lead", "own")).withColumn("common", F.lit(None).cast("long")),
        by_leader=False,
    )
    more = compared(
        staged(pairs.unionByName(met).distinct(), "pairs"), docs, id_col, text
    ).where("links")
    found = staged(components(staged(links.unionByName(more.select("a", "b")), "links")), "components")
    ids = labelled(classes.select("d1", "d2", "n_shingles", "node"), found).drop("node")
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(
        ids.withColumnRenamed("n_shingles", "_n"),
        (signed["d1"] == ids["d1"]) & (signed["d2"] == ids["d2"])
        & (F.col("n_shingles") == F.col("_n")) & F.col("doc_id").isNotNull(),
        "left",
    ).select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def different(x: Column, y: Column) -> Column:
    """How many of the sixteen four-bit parts of two longs differ."""
    z = x.bitwiseXOR(y)
    z = z.bitwiseOR(F.shiftright(z, 1))
    z = z.bitwiseOR(F.shiftright(z, 2))
    return F.bit_count(z.bitwiseAND(F.lit(0x1111111111111111)))


def leaders(members: DataFrame) -> DataFrame:
    """``key, lead``: of each table the node that shares most places in all its tables."""
    loads = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weights = members.join(loads, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    return (
        members.select("key", "node")
        .join(weights, "node")
        .groupBy("key")
        .agg(F.max(F.struct("weight", -F.col("node"))).alias("best"))
        .select("key", (-F.col("best.col2")).alias("lead"))
    )


def tried_by_leader(rows: DataFrame) -> DataFrame:
    """Rows that shingles of their leader may link with another row of the table.

    A link needs common >= top / (top + bottom) * (sum of sizes), and the other size is at
    least top / bottom of this one: so this row shares top / bottom of its own shingles with
    the leader. Rows that only have a passage in common with it are never paired here.
    """
    top, bottom = SIMILAR
    enough = bottom * F.col("common") >= top * F.col("sketch.n_shingles")
    return rows.where(F.col("node") != F.col("lead")).where(F.col("common").isNull() | enough)


def alike(rows: DataFrame, by_leader: bool) -> DataFrame:
    """Distinct pairs ``a < b`` of rows with one ``key`` that lie apart and pass the filter.

    ``by_leader``: without those that shingles of their leader cannot link.
    """
    top, bottom = SIMILAR
    a, b = (
        rows.select(
            "key",
            *(F.col(c).alias(f"{c}_{n}") for c in ("node", "component", "sketch", "common")),
        )
        for n in "ab"
    )
    bits = F.col("sketch_a.bits"), F.col("sketch_b.bits")
    sizes = F.col("sketch_a.n_shingles"), F.col("sketch_b.n_shingles")
    quick = sum((different(bits[0][k], bits[1][k]) for k in range(QUICK // 16)), F.lit(0))
    # one small interpreted loop: as one expression it is too long for the JVM to compile
    differ = F.aggregate(F.zip_with(*bits, different), F.lit(0), lambda s, n: s + n)
    may = (
        (F.col("node_a") < F.col("node_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (bottom * F.least(*sizes) >= top * F.greatest(*sizes))
    )
    if by_leader:  # in common >= top / (top + bottom) * (sum of sizes) is what a link needs
        most = F.least("common_a", "common_b")  # of the known ones
        known = F.col("common_a").isNotNull() & F.col("common_b").isNotNull()
        may = may & (~known | ((top + bottom) * most >= top * (sizes[0] + sizes[1])))
    return (
        a.join(b, "key")
        .where(may & (quick <= MOST_QUICK) & (differ <= MOST_DIFFERENT))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    Every row counts for itself, whatever its id: repeated rows and copies without an id are
    copies like any other, and different texts that share an id are different documents. For
    this the rows are stored once more, numbered. Rows with an empty set all stay.
    """
    row = free_name(docs, "_row")
    numbered = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    keep = near_duplicates(numbered, row, text).where("kept").select(F.col("doc_id").alias(f"{row}_kept"))
    return numbered.join(keep, F.col(row) == F.col(f"{row}_kept"), "left_semi").drop(row)
