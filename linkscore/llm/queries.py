"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore.llm import decontaminate, jaccard, language, lexical, lines, merkle, mixing, multiindex, pii, ppm, quality, secrets, substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None):
    def wrap(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return wrap


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts, calibrated quality, and whether a document stays."""
    return quality.quality_rules(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_query()
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles are 90% the same."""
    return jaccard.jaccard_components(_documents(spark, sf_dir), n=3, percent=90).select("doc_id", "n_shingles", "component_id")


@_query(
    """WITH l AS (
        SELECT doc_id, pos, parts[pos] AS line,
          translate(trim(parts[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
    o AS (SELECT key, max(doc_id) AS last_id FROM l WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT l.*, o.key IS NOT NULL AND l.doc_id <> o.last_id AS gone FROM l LEFT JOIN o ON l.key = o.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id"""
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that at least three documents share, dropped from all but the last."""
    out = lines.dedup_lines(_documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets, and weak candidates whose complementary parts stand close together."""
    return secrets.scan(_documents(spark, sf_dir)).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


@_query()
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those whose id is not held out."""
    docs = _documents(spark, sf_dir)
    held_out = language.id_bucket(F.col("doc_id"), 4) == 2
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@_query()
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontaminate.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_query()
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with personal numbers, dates and addresses permuted within their format."""
    return pii.pseudonymise_documents(_documents(spark, sf_dir), b"linkscore-pseudonyms-1")


_SEATS = """q{0} AS (SELECT {1}, {2}, weight_{0} / (2 * k + 1) AS quotient FROM p{0}, range(0, {3}) AS r(k)
      WHERE weight_{0} > 0 AND k <= seats * weight_{0} / total + parties + 1),
    s{0} AS (SELECT {1}, {2}, count(*) AS won FROM (
      SELECT q.*, p.seats, row_number() OVER (PARTITION BY q.{1} ORDER BY quotient DESC, q.{2}) AS ranked
      FROM q{0} q JOIN p{0} p ON p.{1} = q.{1} AND p.{2} = q.{2}) WHERE ranked <= seats GROUP BY 1, 2)"""


@_query(
    r"""WITH RECURSIVE z AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
      FROM documents),
    t AS (SELECT source, sum(size)::BIGINT AS source_size FROM z GROUP BY source),
    n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM t),
    w AS (SELECT *, [3, 1, 2][(nth - 1) % 3 + 1] AS weight FROM n),
    share AS (
      SELECT 0 AS step, nth, false AS stopped FROM w
      UNION ALL
      SELECT step + 1, nth, again FROM (
        SELECT s.step, s.nth, s.stopped, s.stopped OR 4.0 * w.source_size *
            sum(CASE WHEN s.stopped THEN 0 ELSE w.weight END) OVER ()
          <= w.weight * (3 * sum(w.source_size) OVER () - 4 * sum(CASE WHEN s.stopped THEN w.source_size ELSE 0 END) OVER ()) AS again,
          count(*) OVER () AS parties
        FROM share s JOIN w ON w.nth = s.nth) WHERE step < parties),
    f AS (SELECT nth, stopped FROM share WHERE step = (SELECT max(step) FROM share)),
    g AS (SELECT w.*, CASE WHEN stopped THEN CAST(2 * source_size AS DOUBLE) ELSE
        CAST(weight * (3 * sum(source_size) OVER () - 4 * sum(CASE WHEN stopped THEN source_size ELSE 0 END) OVER ()) AS DOUBLE)
        / CAST(2 * sum(CASE WHEN stopped THEN 0 ELSE weight END) OVER () AS DOUBLE) END AS target
      FROM w JOIN f ON f.nth = w.nth),
    p1 AS (SELECT 0 AS one, nth, target AS weight_1, sum(target) OVER () AS total, count(*) OVER () AS parties,
        CAST(floor((3 * sum(source_size) OVER () + 32) / 64) AS BIGINT) AS seats FROM g),
    """
    + _SEATS.format(1, "one", "nth", "(SELECT max(seats) + 2 FROM p1)")
    + """,
    src AS (SELECT g.*, least(coalesce(won, 0), CAST(floor(2 * source_size / 32) AS BIGINT)) AS blocks,
        greatest(1, CAST(ceil(source_size / 1000000) AS BIGINT)) AS shards
      FROM g LEFT JOIN s1 ON s1.nth = g.nth),
    d AS (SELECT z.*, s.nth, s.source_size, s.target, s.blocks,
        CAST('0x' || substr(digest, 1, 8) AS BIGINT) % s.shards AS shard
      FROM z JOIN src s ON z.source IS NOT DISTINCT FROM s.source),
    h AS (SELECT nth, shard, sum(size)::BIGINT AS shard_size, max(blocks) AS blocks FROM d GROUP BY nth, shard),
    p2 AS (SELECT nth, shard, CAST(shard_size AS DOUBLE) AS weight_2, sum(shard_size) OVER (PARTITION BY nth) AS total,
        count(*) OVER (PARTITION BY nth) AS parties, blocks AS seats FROM h),
    """
    + _SEATS.format(2, "nth", "shard", "(SELECT max(seats) + 2 FROM p2)")
    + """,
    u AS (SELECT h.nth, h.shard, shard_size,
        32 * least(coalesce(won, 0), CAST(floor(2 * shard_size / 32) AS BIGINT)) AS words,
        CAST('0x' || substr(md5('mix-1:' || h.nth || ':' || h.shard), 1, 8) AS BIGINT)
          % greatest(1, CAST(floor(shard_size / 32) AS BIGINT)) * 32 AS begin_at
      FROM h LEFT JOIN s2 ON s2.nth = h.nth AND s2.shard = h.shard),
    v AS (SELECT d.*, u.shard_size, u.begin_at, coalesce(words // nullif(u.shard_size, 0), 0) AS rounds,
        u.begin_at + coalesce(words % nullif(u.shard_size, 0), 0) AS stop_at,
        sum(size) OVER (PARTITION BY d.nth, d.shard ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN u ON u.nth = d.nth AND u.shard = d.shard)
    SELECT doc_id, size, source_size, target, CAST(rounds * size
      + greatest(0, least(upto, stop_at) - greatest(upto - size, begin_at))
      + greatest(0, least(upto, stop_at - shard_size) - (upto - size)) AS BIGINT) AS taken
    FROM v"""
)
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document, source targets met by whole blocks."""
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@_query()
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after spans of 13 words or more that an earlier document holds are removed."""
    out = substrings.remove_repeated(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under word counts and under the byte model."""
    return ppm.score_documents(_documents(spark, sf_dir))


_TREE = """{0} AS (SELECT {1}, 0 AS level, i, digest, count(*) OVER (PARTITION BY {1}) AS size FROM {2}
      UNION ALL
      SELECT {1}, level + 1, i // 16, sha256(string_agg(digest, '' ORDER BY i)), (min(size) + 15) // 16
      FROM {0} WHERE size > 1 GROUP BY {1}, level, i // 16),
    {0}_path AS (SELECT {1}, level, i, concat(
        string_agg(digest, '') OVER (PARTITION BY {1}, level, i // 16 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '.',
        string_agg(digest, '') OVER (PARTITION BY {1}, level, i // 16 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS step
      FROM {0} WHERE size > 1)"""
_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"


@_query(
    "WITH RECURSIVE c AS (SELECT *, 4294967295 - list_reduce(list_prepend(4294967295, flatten([[CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]"
    " FOR x IN string_split(CAST(doc_id AS VARCHAR), '')])),"
    " lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc FROM documents),\n"
    "    h AS (SELECT doc_id, coalesce('=' || source, '-') AS tree, "
    + _LEAF.format("text")
    + " AS digest, CASE WHEN crc % 5 = 0 THEN "
    + _LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    + " END AS other FROM c),\n    d AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS i FROM h),\n    "
    + _TREE.format("node", "tree", "d")
    + """,
    s AS (SELECT 0 AS one, tree, digest, row_number() OVER (ORDER BY tree) - 1 AS i FROM node WHERE size = 1),
    """
    + _TREE.format("upper", "one", "s")
    + """,
    own AS (SELECT tree, i, list(step ORDER BY level) AS steps FROM (
      SELECT d.tree, d.i, p.level, p.step FROM d JOIN node_path p ON p.tree = d.tree AND p.i = d.i // CAST(power(16, p.level) AS BIGINT))
      GROUP BY tree, i),
    above AS (SELECT tree, list(step ORDER BY level) AS steps FROM (
      SELECT s.tree, p.level, p.step FROM s JOIN upper_path p ON p.i = s.i // CAST(power(16, p.level) AS BIGINT)) GROUP BY tree),
    f AS (SELECT d.*, s.digest AS subroot, list_concat(coalesce(own.steps, []), coalesce(above.steps, [])) AS steps
      FROM d JOIN s ON s.tree = d.tree LEFT JOIN own ON own.tree = d.tree AND own.i = d.i LEFT JOIN above ON above.tree = d.tree),
    g AS (SELECT f.*, (SELECT digest FROM upper WHERE size = 1) AS root,
        list_reduce(list_prepend(coalesce(other, digest), steps),
          lambda a, x: sha256(split_part(x, '.', 1) || a || split_part(x, '.', 2))) AS folded_root FROM f)
    SELECT doc_id, digest AS leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '.', '')) AS proof_sha256,
      folded_root, folded_root = root AS verified FROM g"""
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots of the corpus, the proof of every row, and which rows no longer verify."""
    return merkle.manifest_proofs(_documents(spark, sf_dir))


@_query(
    """WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    u AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (SELECT r AS a, vec_id AS found, r AS b FROM v
      UNION SELECT reach.a, v.vec_id, v.r FROM reach JOIN l ON l.a = reach.b JOIN v ON v.r = l.b),
    c AS (SELECT a, min(found) AS component_id FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS links FROM l GROUP BY a)
    SELECT v.vec_id, coalesce(n.links, 0) AS n_links, c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
    FROM v JOIN c ON c.a = v.r LEFT JOIN n ON n.a = v.r"""
)
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label that are 0.98 the same, and the first of each."""
    return multiindex.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@_query(
    r"""WITH t AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS r, * FROM documents)),
    q AS (SELECT r, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS r, * FROM benchmark)),
    p AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    d AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
    s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
    x AS (SELECT q.r, q.item_id, p.r AS doc, p.doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs) // total)))))::BIGINT AS score
      FROM q JOIN p ON p.term = q.term JOIN w ON w.term = q.term JOIN d ON d.r = p.r, s GROUP BY ALL HAVING score > 0)
    SELECT item_id, rank, doc_id, score FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM x)
    WHERE rank <= 10"""
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return lexical.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
