"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set gets K MinHash coordinates; each (coordinate, value)
pair is a posting list. Two sets of similarity J agree on K*J coordinates on
average, and a pair is kept when at least T coordinates agree; T lies so far
below K*J that a true link is missed about once in a million. The lists are
merged with two exact shortcuts: values held by one set never collide (skip),
and a pair with T common values shares one of the K-T+1 rarest of each side
(prefix), so only those are posted. Kept pairs are confirmed on the full sets,
made again from the two texts: a text is shorter than its set of hashes, and only
texts of pairs are moved.

Groups of copies never become all pairs. Equal sets are one representative.
Representatives of a list are compared with the list's hub, in two rounds with
different hubs; only lists whose members are still in different components then
are looked at further, over pairs from different components. In long lists these
must also share one of the rarest shingles of their full sets, at places that both
sizes allow (an exact prefix filter, which leaves out the many members of a large
group that are near it, but not near enough).

Edge cases: null or empty texts, and texts of white space only, have an empty
set, link with nothing and are kept; with fewer words than a shingle has, the
whole sequence is the one shingle; rows with equal doc_id are one document of
the smallest set hash; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import among, as_bytes, hash_words, mix64, ship_package, stream64, text_batches, written

#: Coordinates, and agreements that a kept pair needs. For a similarity of 0.8,
#: P(Binomial(32, 0.8) < 14) is below 2e-6.
COORDINATES, AGREEMENTS = 32, 14
#: Lists of up to so many members are joined with themselves; the longer ones,
#: whose pairs could be many, go through the prefix filter of the full sets.
SHORT_LIST = 64
#: The largest set of a range of sizes has so many times the smallest one's shingles.
SIZE_RANGE = 1.05

_A, _B = stream64(COORDINATES, 101) | np.uint64(1), stream64(COORDINATES, 102)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, concatenated and ascending within
    each text, and the texts' offsets."""
    words, _, at = hash_words(texts)
    count = np.diff(at)
    mixed = [mix64(words + s) for s in stream64(width, 7)]
    whole = np.maximum(count - width + 1, np.minimum(count, 1))  # shingles of each text
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(whole, out=offsets[1:])
    owner = np.repeat(np.arange(len(texts)), whole)
    begin = at[:-1][owner] + (np.arange(offsets[-1]) - offsets[:-1][owner])
    size = np.minimum(count, width)[owner]
    h = np.zeros(len(begin), np.uint64)
    for k in range(width):
        inside = k < size
        h[inside] += mixed[k][begin[inside] + k]
    h = mix64(h + size.astype(np.uint64))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[first], owner[first]
    return h, np.searchsorted(owner, np.arange(len(texts) + 1))


def _nibbles(sig: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate, 16 coordinates to a signed 64-bit integer."""
    low = (sig >> np.uint32(7)).astype(np.uint64) & np.uint64(15)
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.stack([(low[:, i:i + 16] << shift).sum(1, dtype=np.uint64) for i in range(0, COORDINATES, 16)], 1).view(np.int64)


def _sign(batches, width: int):
    import pyarrow as pa
    for batch in batches:
        texts, ids = as_bytes(batch.column(1)), batch.column(0)
        for a, b in text_batches(texts):
            h, at = shingle_sets(texts[a:b], width)
            n = np.diff(at)
            sums = np.zeros((b - a, 2), np.uint64)
            sig = np.zeros((b - a, COORDINATES), np.uint32)
            full = np.flatnonzero(n)
            if len(full):
                sums[full, 0] = np.add.reduceat(mix64(h + np.uint64(1)), at[full])
                sums[full, 1] = np.add.reduceat(mix64(h ^ np.uint64(0x5555555555555555)), at[full])
                for k in range(COORDINATES):
                    sig[full, k] = np.minimum.reduceat((h * _A[k] + _B[k]) >> np.uint64(32), at[full])
            bits = _nibbles(sig)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(n, pa.int64()), pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].view(np.int64)),
                 pa.array(bits[:, 0]), pa.array(bits[:, 1]), pa.array([r if c else [] for r, c in zip(sig.view(np.int32).tolist(), n, strict=True)], pa.list_(pa.int32()))],
                ["doc_id", "n", "h1", "h2", "b1", "b2", "sig"])


def _sets(batches, width: int):
    import pyarrow as pa
    for batch in batches:
        texts, ids = as_bytes(batch.column(1)), batch.column(0)
        for a, b in text_batches(texts):
            h, at = shingle_sets(texts[a:b], width)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))], ["rep", "shingles"])


def _confirm(batches, width: int, percent: int):
    """The pairs (src, dst, their texts) whose sets are similar enough; a batch
    makes the set of each text once."""
    import pyarrow as pa
    for batch in batches:
        src, dst = as_bytes(batch.column(2)), as_bytes(batch.column(3))
        for a, b in text_batches([x + y for x, y in zip(src, dst, strict=True)]):
            place: dict = {}
            pairs = [(place.setdefault(x, len(place)), place.setdefault(y, len(place))) for x, y in zip(src[a:b], dst[a:b], strict=True)]
            h, at = shingle_sets(list(place), width)
            sets = np.split(h, at[1:-1])
            both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in pairs])
            n = np.diff(at)[np.array(pairs)].sum(1)
            yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:2]], ["src", "dst"]).filter(pa.array(100 * both >= percent * (n - both)))


#: Sides a and b of a pair: sizes that the similarity allows, and T agreements
#: at least on four bits of each coordinate (never less than on all bits).
_CLOSE = "100 * least(a.n, b.n) >= {s} * greatest(a.n, b.n) AND {agree} >= {t}"


def _agree(x: str, y: str) -> str:
    d = f"({x} ^ {y})"
    half = f"({d} | shiftrightunsigned({d}, 1))"
    return f"bit_count(~({half} | shiftrightunsigned({half}, 2)) & 1229782938247303441L)"  # 0x1111111111111111


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked when
    100 * |intersection| >= percent * |union| of their sets of distinct
    ``width``-word shingles."""
    spark = docs.sparkSession
    ship_package(spark)
    text = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(text.mapInArrow(lambda it: _sign(it, width),
                                     "doc_id long, n long, h1 long, h2 long, b1 long, b2 long, sig array<int>"), "minhash-signatures")
    narrow = signed.groupBy("doc_id").agg(F.min(F.struct("h1", "h2", "n")).alias("s")).select("doc_id", "s.*")
    groups = (narrow.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).checkpoint())
    # members of large groups of copies meet their group under 16 salted keys
    copied = groups.filter("copies > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    members = (narrow.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int"))
               .join(copied.drop("copies"), ["h1", "h2", "n", "salt"], "left")
               .select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")))

    reps = signed.join(groups.select(F.col("rep").alias("doc_id"), "h1", "h2", "n"), ["doc_id", "h1", "h2", "n"]).dropDuplicates(["doc_id"])
    # a row for each coordinate is narrow; sizes and bits join when the lists are cut
    values = (reps.select("doc_id", F.posexplode("sig").alias("k", "v"))
              .select("doc_id", (F.col("k") * (1 << 32) + F.expr("v & 4294967295L")).alias("token")))
    seen = values.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    ranked = (values.join(seen, "token").groupBy("doc_id")
              .agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("t"))  # at most K entries
              .withColumn("t", F.expr(f"slice(t, 1, greatest(size(t) - {AGREEMENTS - 1}, 0))")))
    postings = written(ranked.join(reps.select("doc_id", "n", "b1", "b2"), "doc_id")
                       .select(F.col("doc_id").alias("rep"), "n", "b1", "b2", F.explode("t.token").alias("token")), "minhash-postings")

    agree = f"{_agree('a.b1', 'b.b1')} + {_agree('a.b2', 'b.b2')}"
    close = _CLOSE.format(s=percent, agree=agree, t=AGREEMENTS)

    def star(placed: DataFrame, order: Column) -> DataFrame:
        """Each representative and the hub of one of its lists that agrees
        best with it, where the two are in different components; a list's hub
        is its first member by ``order``."""
        hubs = (placed.groupBy("token").agg(F.min(F.struct(order.alias("o"), "rep", "n", "b1", "b2", "component")).alias("h"), F.count("*").alias("c"))
                .filter("c > 1").select("token", "h.*"))
        return (placed.alias("a").join(hubs.alias("b"), F.expr(f"a.token = b.token AND a.component <> b.component AND {close}"))
                .groupBy("a.rep").agg(F.max(F.struct(F.expr(agree).alias("m"), -F.col("b.rep"))).alias("x"))
                .select(F.col("rep").alias("src"), (-F.col("x.col2")).alias("dst")))

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs, "minhash-pairs")
        held = among(text, "doc_id", pairs.select(F.explode(F.array("src", "dst"))))
        a, b = (held.select(F.col("doc_id").alias(k), F.col("text").alias(f"{k}_text")) for k in ("src", "dst"))
        return (pairs.join(a, "src").join(b, "dst").select("src", "dst", "src_text", "dst_text")
                .mapInArrow(lambda it: _confirm(it, width, percent), "src long, dst long"))

    def placed(links: DataFrame) -> DataFrame:
        return members_of(connected_components(links).withColumnRenamed("node", "rep"))

    def members_of(comp: DataFrame) -> DataFrame:
        return postings.join(comp, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def only_mixed(rows: DataFrame, key: str) -> DataFrame:
        lists = rows.groupBy(key).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select(key)
        return rows.join(lists, key)

    links = confirmed(star(postings.withColumn("component", F.col("rep")), F.col("rep"))).checkpoint()
    links = links.unionAll(confirmed(star(only_mixed(placed(links), "token"), F.xxhash64("rep")))).checkpoint()
    lists = placed(links)
    sizes = (lists.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("c"))
             .filter("lo < hi").select("token", "c"))
    lists = written(lists.join(sizes, "token"), "minhash-lists")
    short = lists.filter(F.col("c") <= SHORT_LIST)
    near = (short.alias("a").join(short.alias("b"), F.expr(f"a.token = b.token AND a.rep > b.rep AND a.component <> b.component AND {close}"))
            .select(F.col("a.rep").alias("src"), F.col("b.rep").alias("dst")).distinct())
    links = links.unionAll(confirmed(near)).checkpoint()
    comp = connected_components(links).withColumnRenamed("node", "rep")
    now = members_of(comp).select("rep", "component", "n", "b1", "b2").distinct()
    still = only_mixed(lists.filter(F.col("c") > SHORT_LIST).select("token", "rep").join(
        now.select("rep", "component"), "rep"), "token").select("rep", "component").distinct()
    # of those, the ones that agree with another component in two neighbouring
    # coordinates; a link of 0.8 misses all 16 pairs once in ten million times
    twos = F.transform(F.sequence(F.lit(0), F.lit(COORDINATES // 2 - 1)), lambda k: F.xxhash64(k, F.get("sig", 2 * k), F.get("sig", 2 * k + 1)))
    twos = still.join(signed.select(F.col("doc_id").alias("rep"), "sig"), "rep").select("rep", "component", F.explode(twos).alias("two"))
    still = only_mixed(twos, "two").select("rep").distinct().checkpoint()
    # exact prefix filter: sets of n and m shingles over the similarity have
    # ``least`` in common, so of the rarest n - least + 1 and m - least + 1 of
    # each one is common, too. Lists are by shingle and both sides' ranges of
    # sizes, so that what a set posts hangs on the sizes it meets there: the
    # shingles that most of a large group share are posted by those only that
    # are near enough to its middle. Shingles of one set only take a place, but
    # are in nobody's list.
    least = f"(({percent} * (%s + %s) + {99 + percent}) div {100 + percent})"
    sets = (among(text, "doc_id", still).withColumnRenamed("doc_id", "rep").join(still, "rep", "left_semi")
            .mapInArrow(lambda it: _sets(it, width), "rep long, shingles array<long>"))
    shingles = (sets
                .select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s")))
    often = shingles.groupBy("s").agg(F.count("*").alias("c")).filter("c > 1")
    step, far = math.log(SIZE_RANGE), math.log(100 / percent) + 1e-9
    smallest = f"greatest(cast(floor(exp(r * {step})) as int), n * {percent} div 100)"
    rare = (shingles.join(often, "s").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("t"))
            .withColumn("own", F.expr(f"cast(floor(ln(n) / {step}) as int)"))
            .withColumn("r", F.explode(F.expr(f"sequence(cast(floor((ln(n) - {far}) / {step}) as int), cast(floor((ln(n) + {far}) / {step}) as int))")))
            .withColumn("t", F.expr(f"slice(t, 1, greatest(size(t) - cast({least % ('n', smallest)} as int) + 1, 0))"))
            .select("rep", "own", "r", F.posexplode("t.s").alias("i", "s")))
    before = shingles.join(often, "s", "left_anti").groupBy("rep").agg(F.count("*").alias("alone"))
    rare = rare.join(before, "rep", "left").join(now, "rep").select(
        "rep", "own", "component", "n", "b1", "b2", F.xxhash64("s", F.least("own", "r"), F.greatest("own", "r")).alias("s"),
        "r", (F.col("i") + F.coalesce("alone", F.lit(0)) + 1).alias("place"))
    rare = written(only_mixed(rare, "s"), "minhash-rare")
    meant = f"{least % ('a.n', 'b.n')}"
    cross = (rare.alias("a").join(rare.alias("b"), F.expr(
        f"a.s = b.s AND a.own = b.r AND a.r = b.own AND a.rep > b.rep AND a.component <> b.component AND a.place <= a.n - {meant} + 1 AND b.place <= b.n - {meant} + 1 AND {close}"))
             .select(F.col("a.rep").alias("src"), F.col("b.rep").alias("dst")).distinct())
    final = connected_components(links.unionAll(confirmed(cross)))
    return (members.join(final.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document stays: the smallest doc_id of every
    component. Rows without a doc_id stay."""
    gone = near_duplicates(docs, width, percent).filter(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
