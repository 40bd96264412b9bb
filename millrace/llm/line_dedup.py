"""Line dedup over content-defined chunks of lines, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WORD_GAP, materialise, packed, unpacked

#: A boundary stands after a line whose rolling hash, over it and the line before, is 0 modulo EVERY.
EVERY = 3
#: A line of more words is a passage: a chunk of its own, which counts like one of several lines. Lines that pass it
#: together are a chunk as well, wherever boundaries stand.
PASSAGE_WORDS = 50
#: Lists of repeated hashes of up to so many rows (8 bytes each) are broadcast; longer ones are shuffled.
BROADCAST_ROWS = 2_000_000


def _split(rows: DataFrame) -> DataFrame:
    """`lines` of the column `text`, and `marks`, the hash of each line and its number of words."""
    lines = rows.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    return lines.withColumn("marks", F.transform("lines", lambda x: F.struct(
        F.xxhash64(x).alias("hash"), F.size(F.array_remove(F.split(x, WORD_GAP), "")).alias("words"))))


def _chunked(rows: DataFrame) -> DataFrame:
    """`chunks` of a split text: the first and the last line of each, and the hashes of its lines.

    Two kinds of boundaries depend on what stands beside them and not on where, so lines put in or taken out move the
    boundaries beside them only. The text is cut where the rolling hash says so, unless it said so a line earlier, and
    around passages: chunks have two lines at least, but at the ends of texts and beside passages. And from each line
    that is not blank goes a chunk that ends as soon as it has more than PASSAGE_WORDS words, so that any longer repeat
    consists of chunks but for a rest of PASSAGE_WORDS words at most. Chunks of several lines or of a passage count,
    unless blank.
    """
    cut = f"transform(marks, (m, i) -> pmod(xxhash64(if(i = 0, null, marks[i - 1].hash), m.hash), {EVERY}) = 0)"
    ends = f"""
        filter(sequence(1, size(marks)), i -> i = size(marks) or marks[i - 1].words > {PASSAGE_WORDS}
            or marks[i].words > {PASSAGE_WORDS} or (cut[i - 1] and (i = 1 or not cut[i - 2])))"""
    full = "filter(sequence(1, size(marks)), i -> marks[i - 1].words > 0)"
    # A chunk that runs to more than PASSAGE_WORDS words has PASSAGE_WORDS + 1 lines at most that are not blank.
    found = f"""
        array_distinct(concat(
            filter(transform(ends, (e, k) -> struct(if(k = 0, 1, ends[k - 1] + 1) as first, e as last)),
                   c -> (c.last > c.first or marks[c.first - 1].words > {PASSAGE_WORDS})
                        and exists(slice(marks, c.first, c.last - c.first + 1), m -> m.words > 0)),
            transform(filter(transform(full, (at, i) -> struct(at as first, aggregate(slice(full, i + 1, {PASSAGE_WORDS + 1}),
                struct(0 as n, at as last), (s, j) -> if(s.n > {PASSAGE_WORDS}, s, struct(s.n + marks[j - 1].words as n, j as last))) as run)),
                r -> r.run.n > {PASSAGE_WORDS}), r -> struct(r.first as first, r.run.last as last))))"""
    hashed = f"""
        transform({found}, c -> struct(c.first as first, c.last as last,
            transform(slice(marks, c.first, c.last - c.first + 1), m -> m.hash) as hashes))"""
    # Each step is bound to a name, so that none is computed again wherever the next one asks for it.
    for name, value in (("full", full), ("ends", ends), ("cut", cut), ("marks", "marks")):
        hashed = f"element_at(transform(array({value}), {name} -> {hashed}), 1)"
    return rows.withColumn("chunks", F.expr(hashed))


def _identified(docs: DataFrame, *passed: Column) -> DataFrame:
    """`doc_id`, `text` and its hash, which together tell documents apart. Rows that agree in both are one document."""
    return docs.select(*passed, F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def _among(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose `key` is in `wanted`; a short list is sent to the rows."""
    short = wanted.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(wanted) if short else wanted, key, "left_semi")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text_hash` and `gone`, the line ranges of chunks of which an equal one stands earlier.

    Earlier is by doc_id (null last), then by place; a chunk that overlaps its first copy in its own document stays.
    Chunks are counted by one hash each, with partial aggregates, so a chunk that a third of all documents share is one
    row of each task. Only chunks whose hash repeats go on, with the hashes of their lines, which must agree one by one
    with those of the first copy. That lines with one hash are the same line is then checked on their bytes, each line
    once however many chunks hold it; chunks with a line of which that is not so are left alone.
    """
    chunks = _chunked(_split(_identified(docs)))
    keys = chunks.select(F.explode(F.transform("chunks", lambda c: F.xxhash64(c["hashes"]))).alias("hash"))
    repeated = materialise(keys.groupBy("hash").count().where("count > 1").select("hash"), "hashes")
    each = chunks.select("doc_id", "text_hash", F.explode("chunks").alias("c")).select(
        "doc_id", "text_hash", F.struct("c.first", "c.last").alias("at"), "c.hashes", F.xxhash64("c.hashes").alias("hash"))
    kept = materialise(_among(each, repeated, "hash"), "chunks")

    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "at")
    same = ["hash", "hashes"]
    first = kept.groupBy(*same).agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n")).where("n > 1").select(*same, "place")
    own = F.col("doc_id").eqNullSafe(F.col("place.doc_id")) & (F.col("text_hash") == F.col("place.text_hash"))
    later = kept.join(first, same).where(~(own & (F.col("at.first") <= F.col("place.at.last"))))

    lines = materialise(kept.select(F.explode("hashes").alias("line")).distinct(), "lines")
    told_apart = _among(_split(_identified(docs)).select(F.explode(F.arrays_zip("marks", "lines")).alias("l")).select(
        F.col("l.marks.hash").alias("line"), F.col("l.lines").alias("text")), lines, "line")
    unequal = told_apart.groupBy("line", "text").count().groupBy("line").count().where("count > 1").select("line")
    unequal = materialise(unequal, "unequal")
    if not unequal.isEmpty():
        held = kept.select(*same, F.explode("hashes").alias("line")).join(unequal, "line", "left_semi").select(*same).distinct()
        later = later.join(held, same, "left_anti")

    found = later.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    # Ranges that overlap become one.
    return materialise(found.withColumn("gone", F.expr("""
        aggregate(gone, cast(array() as array<struct<first:int,last:int>>), (out, g) ->
            if(size(out) > 0 and get(out, size(out) - 1).last >= g.first,
               concat(slice(out, 1, size(out) - 1), array(struct(get(out, size(out) - 1).first as first,
                      greatest(get(out, size(out) - 1).last, g.last) as last))),
               concat(out, array(g))))""")), "repeats")


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and `removed` (ranges of line numbers such as `3-7,9-9`) of every document.

    Null texts count as one empty line, of which nothing goes; an empty table gives an empty result.
    """
    lines = docs.select("doc_id", "text")
    gone = repeated_chunks(lines).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")
    rows = _identified(lines).select("doc_id", "text_hash", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash").eqNullSafe(F.col("gone_hash")))
    return rows.join(gone, same, "left").select(
        "doc_id", "n_lines",
        F.expr("aggregate(coalesce(gone, cast(array() as array<struct<first:int,last:int>>)), 0L, (n, g) -> n + g.last - g.first + 1)").alias("n_removed"),
        F.expr("array_join(transform(sort_array(coalesce(gone, cast(array() as array<struct<first:int,last:int>>))), g -> concat(g.first, '-', g.last)), ',')").alias("removed"))


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents without repeated chunks, with the columns of the input; n_chars follows the text.

    A chunk that repeats keeps its first copy. What is left of a text keeps its order; a text without repeats keeps its
    bytes; null texts stay null; a document may end up empty.
    """
    rows = packed(docs)
    gone = repeated_chunks(docs.select("doc_id", "text")).select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")
    keyed = rows.select("row", F.col("row.doc_id").cast("bigint").alias("doc_id"), F.xxhash64("row.text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash").eqNullSafe(F.col("gone_hash")))
    # Merged at every size: what goes grows with the corpus.
    joined = keyed.join(gone.hint("merge"), same, "left")
    left = F.expr("""array_join(filter(split(row.text, '\n', -1), (l, i) -> not exists(gone, g -> i + 1 between g.first and g.last)), '\n')""")
    done = joined.withColumn("text", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.char_length("text"))
    return unpacked(done, **changed)
