"""The registered queries of the training-data operators, with their DuckDB text where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.llm import (importance, katz, licenses, linecrf, pfair, phrases, simhash, superkmers, surrogates, templates, urlmodel, warc,
                          whitening)
from parcelle.llm.tables import table


def op1_urlmodel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of all page urls."""
    return urlmodel.judge(table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, deduplicated by revisits, read back and resolved."""
    return warc.crawl_to_archive(table(spark, sf_dir, "pages"))[0]


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents (4-word shingles, 4 bits)."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, word for word or re-parameterised."""
    return (templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .select("doc_id", "item_id", "matched", "item_windows"))


def op5_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in Pfair order of their sources (weights: the square root of the sizes)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mix(docs)


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by keyed surrogates."""
    return surrogates.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), count_col="n_replaced")


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz backoff score and base score of all documents."""
    return katz.score(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and matching license templates of all documents, notices wrapped over lines included."""
    return licenses.scan(table(spark, sf_dir, "documents"), wrapped=True)


def op9_linecrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality counts and CRF content share of all documents."""
    return linecrf.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight and Gumbel top-k decision of all documents."""
    rows = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_features", "log_weight", "tempered", "gumbel_score", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four whitened components of all embeddings."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language, from exact phrase counts over all documents."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that windows of 35 words found twice or more cover, and a digest of the words kept."""
    rows = superkmers.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_urlmodel, op2_warc, op3_simhash, op4_templates, op5_pfair, op6_surrogates, op7_katz, op8_licenses,
                                    op9_linecrf, op10_importance, op11_whitening, op12_phrases, op13_superkmers)}

#: DuckDB text. Operator 2's whole result is a group by payload, operators 12 and 13 count phrases and windows; the others
#: keep their models' results out of SQL's reach.
ORACLES: dict[str, str] = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
             f AS (SELECT payload_digest, min(page_id) AS o FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN o IS NULL OR o = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN o <> page_id THEN o END AS refers_to
        FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest""",
    "op12_phrases": r"""
        WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
             w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
             pos AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
             f1 AS (SELECT lang, w[i] AS p, count(*) AS a FROM pos GROUP BY ALL),
             f2 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS a FROM pos WHERE i + 1 <= len(w) GROUP BY ALL),
             f3 AS (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS a FROM pos WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
             n AS (SELECT lang, sum(a)::BIGINT AS n FROM f1 GROUP BY lang),
             cut AS (SELECT f2.lang, x || ' ' || y AS phrase, f2.a, 1 AS cut, l.a AS l, r.a AS r
                     FROM f2 JOIN f1 l ON l.lang = f2.lang AND l.p = x JOIN f1 r ON r.lang = f2.lang AND r.p = y WHERE f2.a >= 10
                     UNION ALL
                     SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, 1, l.a, r.a
                     FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.p = f3.x JOIN f2 r ON r.lang = f3.lang AND r.x = f3.y AND r.y = f3.z
                     UNION ALL
                     SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, f3.a, 2, l.a, r.a
                     FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.x = f3.x AND l.y = f3.y JOIN f1 r ON r.lang = f3.lang AND r.p = f3.z),
             s AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cut),
             best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
             longer AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, x || ' ' || y AS phrase, a FROM f3 UNION ALL SELECT lang, y || ' ' || z, a FROM f3) GROUP BY ALL),
             kept AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase WHERE g.a IS NULL OR 100 * g.a < 50 * b.a),
             top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT top.lang, rank, phrase, a, l, r, n, score FROM top JOIN n ON n.lang = top.lang WHERE rank <= 2000""",
    "op13_superkmers": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             pos AS (SELECT k, w[i] AS word, i, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS win
                     FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
             counted AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS rep FROM pos),
             covered AS (SELECT k, word, i, coalesce(max(CASE WHEN rep THEN i END) OVER (PARTITION BY k ORDER BY i) >= i - 34, false) AS gone FROM counted),
             r AS (SELECT k, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM covered GROUP BY k)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN r ON r.k = d.k""",
}
