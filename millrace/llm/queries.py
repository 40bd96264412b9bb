"""One query for each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    byte_bpe, decontaminate, language, line_dedup, phrases, quality_model, quality_rules, search, secrets, sharding, simhash,
    token_counts, toxicity,
)
from millrace.llm.common import table

#: Where the vocabularies are; parameters of the operators.
RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
#: Columns of the tables that operators read.
DOCUMENTS = ("doc_id", "text", "lang", "source")


def _documents(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: work(table(spark, sf_dir, "documents"))


def _with(other: str, work: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: work(table(spark, sf_dir, "documents"), table(spark, sf_dir, other))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": _documents(secrets.scan),
    "op2_simhash_near_dedup": _documents(simhash.near_duplicates),
    "op3_line_dedup": _documents(line_dedup.summary),
    "op4_toxicity": _with("labels", toxicity.toxicity),
    "op5_token_counts": _documents(lambda docs: token_counts.token_counts(docs, PIECES)),
    "op6_sharding": _documents(sharding.shard),
    "op7_benchmark_decontamination": _with("benchmark", decontaminate.leaks),
    "op8_quality_rules": _documents(quality_rules.quality_rules),
    "op9_byte_bpe": _documents(lambda docs: byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)),
    "op10_quality_classifier": _with("labels", quality_model.quality),
    "op11_phrase_mining": _documents(phrases.phrases),
    "op12_language_id": _documents(language.languages),
    "op13_ranked_search": _with("benchmark", search.ranked),
}


def _scan_sql() -> str:
    """The secret scan in SQL: matches and the stretches between them, numbered, give the positions."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    kinds = [(n, *k) for n, k in enumerate((*secrets.BASE, secrets.CANDIDATE))]
    found = " UNION ALL ".join(f"""
        SELECT rid, owner, repository, {n} AS rank, '{kind}' AS kind, {least} AS least,
               regexp_extract_all(text, {quoted(pattern)}, 0) AS matches,
               regexp_extract_all(text, {quoted(pattern)}, {group}) AS vals,
               string_split_regex(text, {quoted(pattern)}) AS gaps
        FROM docs WHERE regexp_matches(text, {quoted(pattern)})""" for n, kind, pattern, group, least in kinds)
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, chr(1)) AS owner,
                    concat_ws('/', source, lang) AS repository FROM documents),
    found AS ({found}),
    each AS (SELECT rid, owner, repository, rank, kind, least, unnest(matches) AS m, unnest(vals) AS v, unnest(gaps[:len(matches)]) AS g,
                    generate_subscripts(matches, 1) AS i FROM found),
    placed AS (SELECT rid, owner, repository, rank, kind, least, v,
                      sum(length(g) + length(m)) OVER (PARTITION BY rid, rank ORDER BY i)::BIGINT AS stop, length(m) AS n FROM each),
    spans AS (SELECT rid, owner, repository, rank, kind, v, stop - n AS start, stop FROM placed WHERE length(v) >= least),
    kept AS (SELECT * FROM spans s WHERE rank < 3 OR (
                 regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND NOT EXISTS (
                 SELECT 1 FROM spans b WHERE b.rid = s.rid AND b.rank < 3 AND b.start < s.stop AND s.start < b.stop))),
    held AS (SELECT v, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repository)) AS n_repositories FROM kept GROUP BY v),
    judged AS (SELECT kept.*, {secrets.LIVE} AS live, {secrets.COPIED} AS copied, kind || ':' || start || ':' || stop AS spelled FROM kept JOIN held USING (v)),
    summed AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                      count(*) FILTER (kind = 'hex') AS n_hex,
                      string_agg(spelled, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
                      string_agg(spelled, ',' ORDER BY start, rank) FILTER (rank < 3 OR live) AS spans,
                      count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied
               FROM judged GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
           coalesce(n_copied, 0) AS n_copied
    FROM docs LEFT JOIN summed USING (rid)"""


#: Queries that SQL can express: the others hash with functions that the other engine lacks, encode tokens, or fit models.
ORACLES: dict[str, str] = {
    "op1_secret_scan": _scan_sql(), "op11_phrase_mining": phrases.phrases_sql(), "op13_ranked_search": search.ranked_sql(),
}
