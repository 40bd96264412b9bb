"""Near-duplicates by 64-bit SimHash, linked through one-wildcard variants of fingerprint halves."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import by_batch, materialise, packed, unpacked
from millrace.llm.components import connected

#: Words of a shingle, seed of its hash, and shingles whose bits are counted at once.
SHINGLE, SEED, BLOCK = 3, 42, 1 << 15
#: A bucket of up to so many fingerprints is compared pair by pair; larger ones are split by a second wildcard.
PAIRWISE = 32
HALF = "4294967295L"


def fingerprint(text: str) -> int:
    """SimHash of a text as a signed 64-bit integer: bit i is set if over half of the shingle hashes have it.

    ASCII letters are lower-cased, words end at ASCII white space. Texts of fewer words than a shingle hash their whole
    sequence; a text without words has fingerprint zero.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for begin in range(0, len(shingles), BLOCK):
        block = np.array([digest(s, SEED) for s in shingles[begin:begin + BLOCK]], dtype=np.uint64)
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(shingles)).view(np.int64)[0])


def fingerprints(docs: DataFrame, *passed: str) -> DataFrame:
    """The columns in `passed` and `fp bigint` of every whole text; a null text counts as empty."""
    return by_batch(docs, "fp bigint", lambda texts: {"fp": [fingerprint(t) for t in texts]}, *passed)


def _variants(fps: DataFrame) -> DataFrame:
    """Keys of a fingerprint: both halves whole (place 32), and with each of their 32 bits masked (places 0 to 31).

    The fingerprints are dealt over all tasks first, as each of them becomes 66 rows.
    """
    dealt = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.select("fp", F.explode(F.expr(f"""
        transform(sequence(0, 65), v -> shiftleft(cast(v as bigint), 32) |
            (if(v < 33, fp & {HALF}, shiftrightunsigned(fp, 32)) &
             if(v % 33 = 32, {HALF}, {HALF} ^ shiftleft(1L, v % 33))))""")).alias("key"))


def _verified(pairs: DataFrame) -> DataFrame:
    """Pairs at 2 or fewer bits. Under a masked bit only pairs that differ there count: the others share the whole half."""
    place = "cast(shiftright(key, 32) as int)"
    return pairs.filter(f"a <> b and bit_count(a ^ b) <= 2 and ({place} % 33 = 32 or "
                        f"(shiftrightunsigned(a ^ b, {place} % 33 + if({place} < 33, 0, 32)) & 1) = 1)").select("a", "b")


def links(fps: DataFrame) -> DataFrame:
    """Links `a`, `b` whose components are those of all pairs of distinct fingerprints `fp` at 2 or fewer bits.

    Of two halves, one differs in at most one bit: either the half is equal, or it is equal once that bit is masked. So
    fingerprints meet by equality on 66 keys each. A bucket of two is one candidate, larger ones up to PAIRWISE are
    joined and verified. In a bucket beyond that, members get the variants of the other half as well (one further
    masked bit, or two where the first half is whole). Whoever shares such a key differs in two given bits at most, so
    linking each to the smallest of them is enough: no pairs are enumerated, no link is lost, rows stay linear in members.
    With more than about 7e10 distinct fingerprints the average bucket passes PAIRWISE, and members get 32 to 496 keys each.
    """
    variants = _variants(fps)
    buckets = materialise(
        variants.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"),
        "buckets",
    )
    twos = _verified(buckets.filter("n = 2"))
    # Merged at every size: the list of buckets grows with the corpus, and a hot key is split by adaptive execution.
    members = materialise(variants.join(buckets.filter("n > 2").select("key", "n").hint("merge"), "key"), "members")
    few = members.filter(f"n <= {PAIRWISE}")
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key").filter("a < b")
    other = f"if(shiftright(key, 32) < 33, shiftrightunsigned(fp, 32), fp & {HALF})"
    split = members.filter(f"n > {PAIRWISE}").select("key", "fp", F.explode(F.expr(f"""
        if(cast(shiftright(key, 32) as int) % 33 < 32,
           transform(sequence(0, 31), j -> shiftleft(cast(j as bigint), 32) | ({other} & ({HALF} ^ shiftleft(1L, j)))),
           flatten(transform(sequence(0, 30), j -> transform(sequence(j + 1, 31), k ->
               shiftleft(cast(32 + j * 32 + k as bigint), 32) | ({other} & ({HALF} ^ shiftleft(1L, j) ^ shiftleft(1L, k)))))))
        """)).alias("second"))
    least = split.groupBy("key", "second").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = split.join(least.drop("n"), ["key", "second"]).filter("fp <> a").select("a", F.col("fp").alias("b"))
    return twos.union(_verified(pairs)).union(stars)


def classes(fps: DataFrame) -> DataFrame:
    """`fp`, `copies`, `component_id` and `root` of each distinct fingerprint in `doc_id`, `fp`.

    The component is named by its smallest doc_id that is not null (null if it has none); `root` is its smallest
    fingerprint.
    """
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "classes")
    roots = connected(links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", "copies", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return materialise(rooted.join(names, "root").select("fp", "copies", "component_id", "root"), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id and copies of every document.

    `copies` is the number of documents with the same fingerprint. Repeated rows are kept and share a component; rows
    without doc_id are linked like any other but never name a component; an empty table gives an empty result.
    """
    fps = materialise(fingerprints(docs, "doc_id"), "fingerprints")
    return fps.join(classes(fps), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "copies")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, one of each component: the one that names it, or for components without any doc_id one of them.

    Which rows stay is settled among ids and hashes; the texts are shuffled once, to meet that list. Of rows that
    repeat the doc_id and the text of the one that stays, one is kept.
    """
    keyed = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    prints = materialise(fingerprints(keyed, "doc_id", "text_hash"), "fingerprints")
    named = prints.join(classes(prints), "fp").where("doc_id <=> component_id")
    stay = named.groupBy(F.coalesce("component_id", "root").alias("id"), F.col("component_id").isNull().alias("unnamed")).agg(
        F.min(F.struct("text_hash", "doc_id")).alias("stay")).select(F.col("stay.doc_id").alias("stay_id"), F.col("stay.text_hash").alias("stay_hash"))
    rows = packed(docs).select("row", F.coalesce(F.col("row.doc_id").cast("bigint"), F.lit(0)).alias("id"),
                               F.col("row.doc_id").isNull().alias("unnamed"), F.xxhash64("row.text").alias("text_hash"))
    wanted = stay.select(F.coalesce("stay_id", F.lit(0)).alias("id"), F.col("stay_id").isNull().alias("unnamed"),
                         F.col("stay_hash").alias("text_hash")).distinct()
    keys = ["id", "unnamed", "text_hash"]
    kept = rows.join(wanted, keys, "left_semi").groupBy(*keys).agg(F.first("row").alias("row"))
    return unpacked(kept.select("row"))
