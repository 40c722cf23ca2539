"""One query per operator over the given tables, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rootloom.llm import (ann, decontam, katz, linededup, merkle, mixing, neardup, quality, substring, tokencount, urlfilter, vectorcodes,
                          warc)
from rootloom.llm.common import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT h, max(page_id) AS m FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT p.page_id, strlen(p.h)::BIGINT AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN k.m > p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.m > p.page_id THEN k.m END AS refers_to
FROM p LEFT JOIN k ON p.h = k.h""")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Write a record per page, read the archives back."""
    archives = scratch(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), archives)

    def page(column: str):
        return F.expr(f"try_cast(nullif(regexp_extract({column}, '^urn:page:(.*)$', 1), '') AS BIGINT)")
    return warc.read_archives(spark, archives, payloads=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))


@query("op2_decontamination", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 10) AS k, w[i:i + least(len(w), 10) - 1] AS ws
        FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) WHERE len(w) > 0),
dw AS (SELECT rid, i, k, w[i:i + k - 1] AS ws FROM d, (SELECT DISTINCT k FROM win) z, unnest(range(1, len(w) - k + 2)) t(i)),
hit AS (SELECT rid, i, k, item_id FROM dw JOIN win USING (k, ws)),
n AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) t(p) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT rid, item_id::VARCHAR AS x FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.digest(decontam.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


#: The listed addresses of the URL query: (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
             ("com", "/de/", "block")]


@query("op3_url_filter", """
WITH u AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p FROM pages),
r AS (SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
rules(rh, rp, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                     ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
hit AS (SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
        FROM (SELECT DISTINCT host, path FROM h) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        GROUP BY host, path)
SELECT h.page_id, h.host, h.path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN hit USING (host, path)""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Every page against the listed addresses; what no rule fits is allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, folder, "pages"), rules)


@query("op4_line_dedup", r"""
WITH l AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT rid, doc_id, i, ls[i] AS line, translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l, unnest(range(1, len(ls) + 1)) t(i)),
f AS (SELECT k, max(doc_id) AS keeper FROM x WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
y AS (SELECT rid, doc_id, i, line, f.k IS NOT NULL AND doc_id <> keeper AS gone FROM x LEFT JOIN f USING (k))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM y GROUP BY rid""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return linededup.digest(linededup.dedup_lines(docs, report="report"))


@query("op7_substring_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, doc_id, i, w[i:i + 49] AS ws FROM d, unnest(range(1, len(w) - 48)) t(i)),
f AS (SELECT ws, min(doc_id) AS lo FROM win GROUP BY ws),
gone AS (SELECT DISTINCT rid, p FROM win JOIN f USING (ws), unnest(range(i, i + 50)) t(p) WHERE doc_id > lo),
kept AS (SELECT rid, string_agg(w[i], ' ' ORDER BY i) AS s, count(*) AS n
         FROM (SELECT d.rid, w, i FROM d, unnest(range(1, len(w) + 1)) t(i)) a ANTI JOIN gone g ON a.rid = g.rid AND a.i = g.p GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    rows = substring.remove_repeats(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(table(spark, folder, "documents"))


@query("op9_mixing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op8_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_near_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


@query("op6_nearest_neighbours")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return ann.neighbours(table(spark, folder, "embeddings")).select("query_id", "rank", "vec_id", "score")


def crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), "
            "lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")


def merkle_sql(levels: int = 6, above: int = 4) -> str:
    """Trees of up to 16^levels leaves and 16^above sources, level by level."""
    def field(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""l AS (SELECT doc_id, source, {leaf('text')} AS leaf,
      CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(lower)} END AS altered FROM documents)""",
             """a0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, leaf AS d,
      count(*) OVER (PARTITION BY source) AS n, coalesce(altered, leaf) AS f, '' AS proof FROM l)"""]

    def climbed(before: str, after: str, keys: str, carried: str) -> list[str]:
        """One level: siblings to the left and right by place, the run's digest, folding and proof."""
        run = f"PARTITION BY {keys}p // 16"
        return [f"""{after}n AS (SELECT {keys}p, any_value(d) AS d, any_value(n) AS n FROM {before} GROUP BY {keys}p)""",
                f"""{after}s AS (SELECT *, CASE WHEN n = 1 THEN d ELSE sha256(string_agg(d, '') OVER ({run} ORDER BY p
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) END AS up,
      coalesce(string_agg(d, '') OVER ({run} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lt,
      coalesce(string_agg(d, '') OVER ({run} ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rt FROM {after}n)""",
                f"""{after} AS (SELECT {carried}b.p // 16 AS p, s.up AS d, (b.n + 15) // 16 AS n,
      CASE WHEN b.n = 1 THEN f ELSE sha256(lt || f || rt) END AS f, proof || CASE WHEN b.n = 1 THEN '' ELSE lt || rt END AS proof
      FROM {before} b JOIN {after}s s ON {'b.source IS NOT DISTINCT FROM s.source AND ' if keys else ''}b.p = s.p)"""]
    for k in range(levels):
        parts += climbed(f"a{k}", f"a{k + 1}", "source, ", "doc_id, b.source, leaf, ")
    parts.append(f"""t AS (SELECT source, any_value(d) AS d FROM a{levels} GROUP BY source)""")
    parts.append("o AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM t)")
    parts.append(f"""b0 AS (SELECT doc_id, a.source, leaf, d AS subroot, o.p, o.n, d, f, proof
      FROM a{levels} a JOIN o ON a.source IS NOT DISTINCT FROM o.source)""")
    for k in range(above):
        parts += climbed(f"b{k}", f"b{k + 1}", "", "doc_id, b.source, leaf, subroot, ")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, source, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = d AS verified FROM b{above}"""


@query("op11_merkle_manifest", merkle_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether its possibly altered text still proves."""
    return merkle.manifest(table(spark, folder, "documents"))


@query("op12_katz_scores")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return katz.scores(katz.train(table(spark, folder, "documents")))


def codes_sql(rounds: int = 4) -> str:
    """Every part against every entry, as whole numbers in doubles (exact below 2^53)."""
    parts = ["""e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS c
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             """x AS MATERIALIZED (SELECT rid, vec_id, label, p, v, list_inner_product(v, v) AS vv FROM (SELECT rid, vec_id, label, p,
      c[p * len(c) // 4 + 1 : (p + 1) * len(c) // 4] AS v FROM e, unnest(range(4)) t(p)))""",
             """k0 AS MATERIALIZED (SELECT p, k, v, list_inner_product(v, v) AS vv FROM (SELECT p, v, row_number() OVER (PARTITION BY p
      ORDER BY vec_id) - 1 AS k FROM x) WHERE k < 256)"""]

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (SELECT rid, p, min((x.vv + k.vv - 2 * list_inner_product(x.v, k.v))::BIGINT * 256 + k) AS best
      FROM x JOIN k{i} k USING (p) GROUP BY rid, p)"""
    for i in range(rounds):
        parts.append(assigned(i))
        parts.append(f"""s{i} AS (SELECT p, best % 256 AS k, w, sum(v[w])::BIGINT AS s, count(*) AS n
      FROM a{i} JOIN x USING (rid, p), unnest(range(1, len(v) + 1)) t(w) GROUP BY ALL)""")
        parts.append(f"""m{i} AS (SELECT p, k, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY w) AS v FROM s{i} GROUP BY p, k)""")
        parts.append(f"""k{i + 1} AS MATERIALIZED (SELECT p, k, v, list_inner_product(v, v) AS vv FROM (SELECT p, k, coalesce(m.v, b.v) AS v
      FROM k{i} b LEFT JOIN m{i} m USING (p, k)))""")
    parts.append(assigned(rounds))
    parts.append(f"""r AS (SELECT rid, string_agg(printf('%02x', best % 256), '' ORDER BY p) AS code, sum(best // 256)::BIGINT AS error FROM a{rounds} GROUP BY rid)""")
    parts.append(f"""d AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY p, k)) AS digest FROM k{rounds})""")
    return "WITH " + ",\n".join(parts) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256 FROM e JOIN r USING (rid), d"""


@query("op13_vector_codes", codes_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return vectorcodes.vector_codes(table(spark, folder, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
