"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialise, whole_text

#: Kinds of the scan: name, pattern, group whose length counts, and its least length in characters.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: Candidates that only ownership can settle: long runs of letters and digits with a digit and both cases.
CANDIDATE = ("owned", r"[A-Za-z0-9+/_=-]+", 0, 24)
#: From so many owners or repositories on a value is a widely copied example.
COPIED_OWNERS, COPIED_REPOSITORIES = 3, 4
#: A value that one owner holds in fewer repositories than that looks live.
LIVE = f"n_owners = 1 and n_repositories < {COPIED_REPOSITORIES}"
COPIED = f"n_owners >= {COPIED_OWNERS} or n_repositories >= {COPIED_REPOSITORIES}"


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (kind, start, end, value) of the leftmost non-overlapping matches whose group is long enough.

    Positions are code points, from the lengths of the stretches between the matches; end is exclusive.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    lengths = F.arrays_zip(
        F.slice(F.transform(F.split(text, pattern, -1), F.char_length), 1, F.size(found)).alias("gap"),
        F.transform(found, F.char_length).alias("length"), values.alias("value"),
    )
    state = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<kind:string,start:int,end:int,value:string>>)").alias("out")),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + m["length"]).alias("at"),
            F.when(F.char_length(m["value"]) < least, s["out"]).otherwise(F.concat(s["out"], F.array(F.struct(
                F.lit(kind).alias("kind"), (s["at"] + m["gap"]).alias("start"),
                (s["at"] + m["gap"] + m["length"]).alias("end"), m["value"].alias("value"))))).alias("out"),
        ),
    )
    # Most texts have no match; they skip the walk.
    return F.when(text.rlike(pattern), state["out"]).otherwise(
        F.expr("cast(array() as array<struct<kind:string,start:int,end:int,value:string>>)"))


def _tight(pattern: str, group: int, least: int) -> str:
    """The pattern with its closing `+` as a least length: the same matches, where runs are as long as they can be."""
    return pattern if group else f"{pattern[:-1]}{{{least - len('AKIA') if pattern.startswith('AKIA') else least},}}"


def candidates(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, owner, repository, and `base` and `more`, all base matches and candidates of every whole text.

    Of values only their SHA-256 goes on: nothing that is written or shuffled holds a secret in clear.

    The table of documents has no repositories; a source in one language stands for one, a source for the owner. A
    candidate that lies over a base match is left out.
    """
    text = F.col("text")
    rows = docs.select("doc_id", F.col(owner).alias("owner"), F.concat_ws("/", *repository).alias("repository"),
                       whole_text().alias("text"))
    base = F.concat(*[_matches(text, kind, _tight(pattern, group, least), group, least) for kind, pattern, group, least in BASE])
    kind, pattern, group, least = CANDIDATE
    more = F.filter(_matches(text, kind, _tight(pattern, group, least), group, least),
                    lambda m: m["value"].rlike("[0-9]") & m["value"].rlike("[a-z]") & m["value"].rlike("[A-Z]"))
    found = rows.select("doc_id", "owner", "repository", base.alias("base"), more.alias("more"))
    hashed = lambda found: F.transform(found, lambda m: F.struct(
        m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.sha2(m["value"], 256).alias("hash")))
    alone = F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return found.select("doc_id", "owner", "repository", hashed(F.col("base")).alias("base"), hashed(alone).alias("more"))


def ownership(found: DataFrame) -> DataFrame:
    """Each distinct value's hash with its occurrences, distinct repositories and distinct owners (null is one of each).

    Occurrences are summed per value, repository and owner before and after the shuffle, so a value that a third of all
    documents hold costs one row per task and owner.
    """
    values = found.select("owner", "repository", F.explode(F.concat("base", "more")).alias("m"))
    each = values.groupBy("m.hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = each.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("hash").agg(
        F.sum("n").alias("n_occurrences"), F.sum("repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners"))


def _spelled(found: str) -> Column:
    order = F.expr(f"""array_sort({found}, (l, r) -> case
        when l.start <> r.start then l.start - r.start
        else cast(array_position(array('assign', 'access', 'hex', 'owned'), l.kind)
                - array_position(array('assign', 'access', 'hex', 'owned'), r.kind) as int) end)""")
    return F.array_join(F.transform(order, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Secrets of every document; one row per document.

    n_assign, n_access, n_hex count base matches; base_sha256 is the digest of their `kind:start:end`, spans lists these
    and the candidates that look live. n_live counts matches whose value looks live, one owner alone holding it in fewer
    than COPIED_REPOSITORIES repositories; n_copied those held by COPIED_OWNERS or in COPIED_REPOSITORIES or more. Null and empty texts have no match, repeated rows stay repeated, null sources are an
    owner of their own, an empty table gives an empty result.
    """
    found = materialise(candidates(docs).withColumn("row", F.monotonically_increasing_id()), "secrets")
    held = ownership(found)
    each = found.select("row", F.explode(F.concat("base", "more")).alias("m")).withColumn("hash", F.col("m.hash"))
    judged = each.join(held, "hash").groupBy("row").agg(
        F.count_if(F.expr(LIVE)).alias("n_live"), F.count_if(F.expr(COPIED)).alias("n_copied"),
        F.collect_list(F.when((F.col("m.kind") == CANDIDATE[0]) & F.expr(LIVE), F.col("m"))).alias("owned"))
    rows = found.join(judged, "row", "left")
    count = lambda kind: F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("bigint")
    return rows.withColumn("spans", F.concat("base", F.coalesce("owned", F.filter("base", lambda m: F.lit(False))))).select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(_spelled("base"), 256).alias("base_sha256"), _spelled("spans").alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))
