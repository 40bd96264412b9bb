"""Phrases whose words stand together more often than apart, mined on relations of occurrences that are merged and counted."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialise, rows_by_batch, whole_text
from millrace.session import scratch_folder

#: Where pieces and words of a text end.
PIECE_END, WORD_END = r"[.,;:!?\x0A-\x0D]", r"[\x20\x09]+"
#: Words of the longest phrase, occurrences of a candidate, share in percent of its occurrences inside a longer one that
#: drops it, phrases given for each language, and the scale of scores.
LONGEST, LEAST, INSIDE_PERCENT, MOST, SCALE = 3, 10, 50, 2000, 1_000_000
#: Rows of a sorted bucket of a relation, and most buckets of a table in Spark.
BUCKET_ROWS, MOST_BUCKETS = 4_000_000, 100_000
#: Lists of frequent hashes of up to so many rows (8 bytes each) are broadcast. Of longer ones a table of bits is, with so many
#: bits a hash at least, unless that were more than so many (64 MB).
BROADCAST_ROWS, BITS_EACH, MOST_BITS = 100_000, 8, 1 << 29
PLACE = ("doc", "piece", "at")
#: Joins may keep a partitioning by one of their keys, as relations are dealt by document and meet by place as well; and files
#: of buckets count as sorted, as they are.
MERGING = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


@contextmanager
def _merging(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in MERGING}
    for name, value in MERGING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _shuffles_end(spark: SparkSession) -> None:
    """Files of ended shuffles go once the driver collects its garbage: it is asked to, so that disks hold those of one step."""
    spark._jvm.System.gc()


def _kept(rows: DataFrame, purpose: str) -> DataFrame:
    frame = materialise(rows, purpose)
    _shuffles_end(rows.sparkSession)
    return frame


def _lowered(docs: DataFrame) -> DataFrame:
    """`doc`, a number of the row, `lang` (null: und) and `text` with A-Z, and no other letters, in lower case."""
    def each(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.ascii_lower(batch.column(1))], names=["lang", "text"])

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole_text().alias("text"))
    return rows_by_batch(rows, "lang string, text string", each).select(F.monotonically_increasing_id().alias("doc"), "lang", "text")


def _occurrences(rows: DataFrame) -> DataFrame:
    """One row per word: its document, piece and place there, language and text."""
    pieces = rows.select("doc", "lang", F.posexplode(F.split("text", PIECE_END)).alias("piece", "words"))
    return pieces.select("doc", "piece", "lang", F.posexplode(F.split("words", WORD_END)).alias("at", "word")).where("word <> ''")


def _numbered(words: DataFrame) -> Column:
    """A 64-bit hash of `lang` and `word` that no two of `words` share; another seed is tried until that is so."""
    seed = 0
    while True:
        hashed = F.xxhash64(F.lit(seed), "lang", "word")
        if words.groupBy(hashed.alias("w")).count().where("count > 1").isEmpty():
            return hashed
        seed += 1


def _among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose `key` is in `wanted`. They stay where they are: a short list is sent to them, of a long one its bits.

    Bits keep some rows besides, up to one in eight of the others, and more once `MOST_BITS` are too few; counts leave
    them out later. A hash sets the bit that its last digits number, in rows of 64 numbers of 64 bits.
    """
    n = wanted.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(wanted), key, "left_semi")
    size = min(MOST_BITS, max(4096, 1 << (BITS_EACH * n - 1).bit_length()))
    line, number, bit = f"shiftright({key} & {size - 1}, 12)", f"cast(shiftright({key}, 6) & 63 as int)", f"cast({key} & 63 as int)"
    numbers = wanted.groupBy(F.expr(line).alias("line"), F.expr(number).alias("number")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits"))
    lines = numbers.groupBy("line").agg(F.map_from_entries(F.collect_list(F.struct("number", "bits"))).alias("by_number"))
    table = lines.select("line", F.expr("transform(sequence(0, 63), i -> coalesce(try_element_at(by_number, i), 0L))").alias("bits"))
    return rows.join(F.broadcast(table), (F.expr(line) == F.col("line")) & F.expr(f"getbit(get(bits, {number}), {bit}) = 1"), "left_semi")


def _dropped(spark: SparkSession, relation: DataFrame, name: str) -> None:
    """Ends a relation that no later round reads."""
    for file in relation.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _persisted(rows: DataFrame, words: list[str], buckets: int) -> tuple[DataFrame, str]:
    """A relation and its name, written as a table with one sorted file per bucket of documents, so that it merges without a shuffle."""
    spark, name = rows.sparkSession, f"phrases_{uuid.uuid4().hex}"
    rows.select(*PLACE, *words).write.format("parquet").bucketBy(buckets, "doc").sortBy(*PLACE).option(
        "path", scratch_folder(spark, "phrases")).saveAsTable(name)
    _shuffles_end(spark)
    return spark.table(name), name


def _extended(relation: DataFrame, length: int) -> DataFrame:
    """Occurrences of `length` + 1 words: those of `length` merged with the ones that begin a word later in their piece."""
    words = [f"w{i}" for i in range(1, length + 1)]
    later = relation.select("doc", "piece", (F.col("at") - 1).alias("at"), F.col(words[-1]).alias(f"w{length + 1}"))
    return relation.join(later.hint("merge"), [*PLACE])


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[dict[int, DataFrame], DataFrame]:
    """Phrases by length, each with its number of occurrences `f` (`least` or more), and `n`, all words of each language.

    Words are hashes `w1`, `w2` and so on; phrases of one word have `lang` and `word` besides. Each round merges the
    relation of the last one with itself at adjacent places, counts groups, and leaves in the next relation only
    occurrences of groups that may be frequent. What is counted first is the hash of a group, one number in the shuffle
    instead of all its words; groups that share a hash are then told apart by exact counts of the few that are left.
    Counts combine before the shuffle, so a group with a third of all occurrences is one row of each task.
    """
    spark = docs.sparkSession
    lowered = _lowered(docs)
    words = _kept(_occurrences(lowered).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f")), "words")
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n")).head()["n"]
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_ROWS)))
    hashed = _numbered(words)
    found = {1: _kept(words.where(f"f >= {least}").select(hashed.alias("w1"), "lang", "word", "f"), "frequent")}
    with _merging(spark):
        occurrences = _occurrences(lowered.repartition(buckets, "doc")).select(*PLACE, hashed.alias("w1"))
        relation, name = _persisted(_among(occurrences, "w1", found[1].select("w1")), ["w1"], buckets)
        for length in range(2, longest + 1):
            names = [f"w{i}" for i in range(1, length + 1)]
            groups = _extended(relation, length - 1).withColumn("group", F.xxhash64(*names))
            likely = _kept(groups.groupBy("group").count().where(f"count >= {least}").select("group"), "groups")
            left = _among(groups, "group", likely)
            if length < longest:
                before, old = relation, name
                relation, name = _persisted(left, names, buckets)
                _dropped(spark, before, old)
                left = relation
            found[length] = _kept(left.groupBy(*names).agg(F.count(F.lit(1)).alias("f")).where(f"f >= {least}"), "frequent")
        _dropped(spark, relation, name)
    return found, sizes


def _with_cuts(found: dict[int, DataFrame], length: int) -> DataFrame:
    """Candidates of `length` words with `lang`, `a`, and the score, l and r of their lowest-scoring cut."""
    names = [f"w{i}" for i in range(1, length + 1)]
    rows = found[length].select(*names, F.col("f").alias("a"))
    cuts = []
    for k in range(1, length):
        first = found[k].select(*names[:k], F.col("f").alias(f"l{k}"), *(["lang"] if k == 1 else []))
        rest = found[length - k].select(*[F.col(f"w{i + 1}").alias(names[k + i]) for i in range(length - k)], F.col("f").alias(f"r{k}"))
        rows = rows.join(first, names[:k]).join(rest, names[k:])
        exact = lambda x: f"cast({x} as decimal(18, 0))"
        score = f"cast({SCALE} as decimal(7, 0)) * ({exact('a')} * {exact('a')}) div ({exact(f'l{k}')} * {exact(f'r{k}')})"
        cuts.append(F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    return rows.select("lang", *names, "a", F.least(*cuts).alias("cut") if len(cuts) > 1 else cuts[0].alias("cut")).select(
        "lang", *names, "a", "cut.score", "cut.l", "cut.r")


def _standing_alone(rows: DataFrame, found: dict[int, DataFrame], length: int) -> DataFrame:
    """Candidates of which too few occurrences lie inside a longer candidate to drop them."""
    names = [f"w{i}" for i in range(1, length + 1)]
    for longer in range(length + 1, max(found) + 1):
        inside = None
        for begin in range(longer - length + 1):
            part = found[longer].select(*[F.col(f"w{begin + i + 1}").alias(names[i]) for i in range(length)], "f")
            inside = part if inside is None else inside.union(part)
        most = inside.groupBy(*names).agg(F.max("f").alias("inside")).withColumnRenamed("inside", f"in{longer}")
        rows = rows.join(most, names, "left").where(f"coalesce(100 * in{longer} < {INSIDE_PERCENT} * a, true)").drop(f"in{longer}")
    return rows


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, most: int = MOST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the `most` best phrases of each language.

    Null texts are empty, null languages are `und`, repeated rows count each time; texts without phrases and empty tables
    give nothing. Scores are whole numbers of exact decimals. Ties go by occurrences, then by the phrase.
    """
    found, sizes = frequent_phrases(docs, longest, least)
    spelled = found[1].select("w1", "word")
    out = None
    for length in range(2, longest + 1):
        rows = _standing_alone(_with_cuts(found, length), found, length)
        rows = rows.select("lang", F.array(*[f"w{i}" for i in range(1, length + 1)]).alias("words"), "a", "l", "r", "score")
        out = rows if out is None else out.union(rows)
    best = F.rank().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc()))
    top = out.withColumn("best", best).where(f"best <= {most}").drop("best")
    # Only what may rank is spelled out.
    for k in range(longest):
        word = spelled.select(F.col("w1").alias(f"w{k}"), F.col("word").alias(f"word{k}"))
        top = top.withColumn(f"w{k}", F.get("words", F.lit(k))).join(word, f"w{k}", "left")
    top = top.withColumn("phrase", F.concat_ws(" ", *[f"word{k}" for k in range(longest)]))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = top.withColumn("rank", F.row_number().over(order).cast("bigint")).where(f"rank <= {most}")
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def phrases_sql(longest: int = LONGEST, least: int = LEAST, most: int = MOST) -> str:
    """`phrases` of documents, in SQL."""
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ".lower()
    counted = " UNION ALL ".join(f"""
        SELECT lang, {k} AS k, array_to_string(ws[i:i + {k - 1}], ' ') AS phrase
        FROM (SELECT lang, ws, unnest(range(1, len(ws) - {k - 2})) AS i FROM words)""" for k in range(1, longest + 1))
    inside = " UNION ALL ".join(f"""
        SELECT lang, array_to_string(ws[i:i + {k - 1}], ' ') AS phrase, a AS longer
        FROM (SELECT lang, string_split(phrase, ' ') AS ws, a, unnest(range(1, k - {k - 2})) AS i FROM candidates WHERE k > {k})"""
        for k in range(2, longest + 1))
    return f"""
    WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), '{capitals}', '{small}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
    counted AS ({counted}),
    f AS (SELECT lang, k, phrase, count(*)::BIGINT AS a FROM counted GROUP BY ALL),
    sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT * FROM f WHERE k > 1 AND a >= {least}),
    cut AS (SELECT *, array_to_string(ws[:j], ' ') AS head, array_to_string(ws[j + 1:], ' ') AS tail
            FROM (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS j FROM candidates)),
    scored AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, ({SCALE}::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score,
                      row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY ({SCALE}::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a), j) AS cheapest
               FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
    inside AS (SELECT lang, phrase, max(longer) AS longer FROM ({inside}) GROUP BY ALL),
    alone AS (SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase)
              WHERE cheapest = 1 AND NOT coalesce(100 * longer >= {INSIDE_PERCENT} * a, false)),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM placed JOIN sizes USING (lang) WHERE rank <= {most}"""
