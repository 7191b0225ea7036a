"""The thirteen queries with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontaminate, filter_audit, jaccard_join, langid, line_frequency, mixing, pii, secrets, sessions, substring_dedup, url_reputation, zstd_quality
from .common import LOWER, UPPER, in_fold, read


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(read(spark, sf_dir, "pages"), url_reputation.outcomes_of(read(spark, sf_dir, "labels")))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_frequency.drop_boilerplate(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "n_lines", "n_dropped", "all_dropped", F.length("text").cast("long").alias("chars_left"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("spans")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(read(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.classify(docs, langid.learn(docs))
    return found.select("doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents")).withColumn("weight", F.round("weight", 6))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = zstd_quality.scores(docs, zstd_quality.learn(docs, read(spark, sf_dir, "labels")))
    return found.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score", F.when(F.col("score") >= zstd_quality.THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(secrets.as_text(F.col("base")), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"))


def op10_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(read(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.BASE))
    return found.select("doc_id", *map(of, pii.BASE), F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"), F.array_join(F.transform("spans", lambda x: x["score"].cast("string")), ",").alias("scores"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sessions.sessionise(read(spark, sf_dir, "clicks"))
    return found.withColumn("path_sha256", F.sha2(F.array_join(F.col("path").cast("array<string>"), ","), 256)).drop("path")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_url_reputation, op2_line_frequency, op3_decontaminate, op4_substring_dedup, op5_jaccard_join, op6_language_id, op7_mixing, op8_quality, op9_secrets, op10_collision_ann, op11_pii, op12_filter_audit, op13_gap_sessions)
    return {f.__name__: f for f in found}


def _op1_sql() -> str:
    stated = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
    two = ", ".join(f"'{x}'" for x in url_reputation.TWO_LABEL_SUFFIXES)
    fits = {r: f"((host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}'))" for r, _ in stated}
    rules = sorted(stated, key=lambda r: (-len(r[0]), r[0]))
    case = lambda k: "CASE " + " ".join(f"WHEN {fits[r[0]]} THEN '{r[k]}'" for r in rules) + " END"

    def rho(groups: str, m: str) -> str:
        return f"(SELECT 1 / least(greatest(coalesce(sum(pow(b - n * {m}, 2) - n * {m} * (1 - {m})) / nullif(sum((n - 1) * n * {m} * (1 - {m})), 0), 0.001), 0.001), 0.5) - 1 FROM {groups})"

    return f"""
WITH page AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
outcome AS (SELECT doc_id, CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL THEN 0 END AS bad FROM labels),
known AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS b FROM page LEFT JOIN (SELECT * FROM outcome WHERE bad IS NOT NULL) ON doc_id = page_id GROUP BY host),
part AS (SELECT *, string_split(regexp_replace(regexp_extract(host, '(?s)([^@]*)$', 1), ':\\d*$', ''), '.') AS p FROM known),
cut AS (SELECT *, len(p) AS k, array_to_string(p[greatest(len(p) - 1, 1):], '.') AS last2, array_to_string(p[greatest(len(p) - 2, 1):], '.') AS last3, array_to_string(p, '.') AS bare FROM part),
leaf AS (SELECT host, n, b, CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\\[') OR k = 1 THEN bare WHEN last2 IN ({two}) THEN last2 ELSE p[len(p)] END AS suffix,
    CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\\[') OR k = 1 THEN bare WHEN last2 IN ({two}) THEN last3 ELSE last2 END AS domain FROM cut),
top AS (SELECT (sum(b) + 0.5) / (sum(n) + 1.0) AS m FROM leaf),
sfx AS (SELECT suffix, sum(n) AS n, sum(b) AS b, any_value(m) AS m FROM leaf, top GROUP BY suffix),
sfx2 AS (SELECT suffix, (b + s * m) / (n + s) AS m_suffix FROM sfx, (SELECT {rho('sfx', 'm')} AS s)),
dom AS (SELECT suffix, domain, sum(n) AS n, sum(b) AS b, any_value(m_suffix) AS m FROM leaf JOIN sfx2 USING (suffix) GROUP BY suffix, domain),
dom2 AS (SELECT suffix, domain, (b + s * m) / (n + s) AS m_domain FROM dom, (SELECT {rho('dom', 'm')} AS s)),
hst AS (SELECT host, n, b, m_domain AS m FROM leaf JOIN dom2 USING (suffix, domain)),
rep AS (SELECT host, n, (b + s * m) / (n + s) AS mean, s FROM hst, (SELECT {rho('hst', 'm')} AS s)),
judged AS (SELECT page_id, host, path, {case(0)} AS rule, {case(1)} AS own, n AS n_labelled, greatest(0.0, mean - 1.645 * sqrt(mean * (1 - mean) / (n + s + 1))) AS bound FROM page JOIN rep USING (host))
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN bound >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict, n_labelled, round(bound, 6) AS bad_bound FROM judged"""


def _op2_sql() -> str:
    return """
WITH each AS (SELECT DISTINCT d.rowid AS r, source, trim(u.x, ' \t\r') AS x FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d, unnest(string_split(text, chr(10))) AS u(x) WHERE source IS NOT NULL),
tot AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source),
bp AS (SELECT source, list(x) AS bad FROM (SELECT source, x FROM each JOIN tot USING (source) WHERE x <> '' GROUP BY source, x, pages HAVING count(*) >= 2 AND count(*) > 0.1 * pages) GROUP BY source),
cut AS (SELECT doc_id, documents.source, text, string_split(text, chr(10)) AS lines, list_filter(string_split(text, chr(10)), lambda x: trim(x, ' \t\r') = '' OR NOT coalesce(list_contains(bad, trim(x, ' \t\r')), FALSE)) AS kept FROM documents LEFT JOIN bp ON bp.source = documents.source),
done AS (SELECT *, text IS NOT NULL AND len(kept) < len(lines) AS less FROM cut)
SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(lines) END::BIGINT AS n_lines, CASE WHEN less THEN len(lines) - len(kept) ELSE 0 END::BIGINT AS n_dropped, less AND len(list_filter(kept, lambda x: trim(x, ' \t\r') <> '')) = 0 AS all_dropped,
    length(CASE WHEN less THEN coalesce(array_to_string(kept, chr(10)), '') ELSE text END)::BIGINT AS chars_left, sha256(coalesce(CASE WHEN less THEN array_to_string(kept, chr(10)) ELSE text END, '')) AS text_sha256 FROM done"""


def _op3_sql() -> str:
    words = lambda t: f"regexp_extract_all(translate({t}, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH item AS (SELECT item_id, {words('text')} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
pattern AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS p FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce({words('text')}, []) AS w FROM documents),
spot AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
hit AS (SELECT r, i, s.n, item_id FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM spot, (SELECT DISTINCT n FROM pattern) WHERE i + n - 1 <= len(w)) s JOIN pattern ON pattern.n = s.n AND pattern.p = s.p),
word AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS x FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN ids USING (r)"""


def _op4_sql() -> str:
    blank = "\\x20\\x09-\\x0D"
    return f"""
WITH piece AS (SELECT doc_id, unnest(l) AS p, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[{blank}]*[^{blank}]+') AS l FROM documents WHERE text IS NOT NULL)),
word AS (SELECT doc_id, i, regexp_extract(p, '[^{blank}]+') AS w, sum(length(p)) OVER by_place AS stop, sum(length(p) - length(replace(p, chr(10), ''))) OVER by_place AS line, sum((length(p) - length(replace(p, chr(10), '')) > 1)::INTEGER) OVER by_place AS para FROM piece WINDOW by_place AS (PARTITION BY doc_id ORDER BY i)),
doc AS (SELECT doc_id, list(w ORDER BY i) AS ws, list(stop - length(w) ORDER BY i) AS a, list(stop ORDER BY i) AS z FROM word GROUP BY doc_id),
unit AS (SELECT 'passage' AS kind, doc_id, i, 50 AS n, hash(array_to_string(ws[i:i + 49], ' ')) AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM doc)
    UNION ALL SELECT 'line', doc_id, min(i), count(*), hash(string_agg(w, ' ' ORDER BY i)) FROM word GROUP BY doc_id, line HAVING count(*) >= 20
    UNION ALL SELECT 'line', doc_id, min(i), count(*), hash(string_agg(w, ' ' ORDER BY i)) FROM word GROUP BY doc_id, para HAVING count(*) < 50 AND (count(DISTINCT line) > 1 OR count(*) < 20)),
ranked AS (SELECT *, min(doc_id * 10000000 + i) OVER (PARTITION BY kind, key) AS f FROM unit),
gone AS (SELECT doc_id, i, n, f // 10000000 AS kept FROM ranked WHERE f // 10000000 < doc_id OR f % 10000000 + CASE kind WHEN 'passage' THEN 50 ELSE 1 END <= i),
step AS (SELECT *, CASE WHEN i <= max(i + n) OVER (PARTITION BY doc_id ORDER BY i, n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM gone),
run AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i, n DESC ROWS UNBOUNDED PRECEDING) AS r FROM step),
span AS (SELECT doc_id, min(i) AS i, max(i + n) AS e, arg_min(kept, i * 1000000000000 + kept) AS kept FROM run GROUP BY doc_id, r)
SELECT doc_id, a[i]::BIGINT AS "start", z[e - 1]::BIGINT AS "end", (e - i)::BIGINT AS n_words, kept::BIGINT AS kept_doc_id FROM span JOIN doc USING (doc_id)"""


def _op5_sql() -> str:
    return f"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, hash(s) AS s FROM (SELECT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0))),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, c) AS (SELECT doc_id, doc_id FROM doc UNION SELECT b, c FROM reach JOIN both_ways USING (a))
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM (SELECT a AS doc_id, min(c) AS component_id FROM reach GROUP BY a) LEFT JOIN size USING (doc_id)"""


def _op7_sql() -> str:
    grid_points, passes = 32, 5
    ctes, lo, hi = [], "0.0::DOUBLE", "1.0::DOUBLE"
    ctes.append(f"e0 AS (SELECT {lo} AS lo, {hi} AS hi)")
    grid = lambda prev: f"(SELECT i, lo + (hi - lo) / {grid_points} * i AS x, lo, hi FROM {prev}, range({grid_points + 1}) AS g(i))"
    for k in range(passes):
        ctes.append(f"e{k + 1} AS (SELECT coalesce(max(x) FILTER (WHERE ok), any_value(lo)) AS lo, coalesce(least(max(x) FILTER (WHERE ok) + any_value((hi - lo) / {grid_points}), any_value(hi)), any_value(lo)) AS hi FROM (SELECT x, lo, hi, ln(sum(pow(p, x))) - x * sum(pow(p, x) * ln(p)) / sum(pow(p, x)) >= 0.97 * ln(count(*)) AS ok FROM {grid(f'e{k}')}, share GROUP BY x, lo, hi))")
    ctes.append(f"f0 AS (SELECT lo, 1.0::DOUBLE AS hi FROM e{passes})")
    for k in range(passes):
        ctes.append(f"f{k + 1} AS (SELECT greatest(min(x) FILTER (WHERE ok) - any_value((hi - lo) / {grid_points}), any_value(lo)) AS lo, min(x) FILTER (WHERE ok) AS hi FROM (SELECT x, lo, hi, pow(max(p) / min(p), 1 - x) <= 4.0 AS ok FROM {grid(f'f{k}')}, share GROUP BY x, lo, hi))")
    alpha = f"(SELECT CASE WHEN count(*) < 2 THEN 1.0 WHEN pow(max(p) / min(p), 1 - (SELECT lo FROM e{passes})) > 4.0 THEN (SELECT hi FROM f{passes}) ELSE (SELECT lo FROM e{passes}) END AS a FROM share)"
    key = lambda block: f"md5(concat_ws('|', 'mix-1', {block}::VARCHAR, coalesce(doc_id::VARCHAR, '')))"
    return f"""
WITH tok AS (SELECT doc_id, source, coalesce('=' || source, '-') AS s, coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0)::BIGINT AS n_tokens FROM documents),
tot AS (SELECT s, sum(n_tokens)::BIGINT AS t FROM tok GROUP BY s),
share AS (SELECT s, t, t / (SELECT sum(t) FROM tot)::DOUBLE AS p FROM tot WHERE t > 0),
{', '.join(ctes)},
al AS {alpha},
zz AS (SELECT sum(pow(p, a)) AS z, max(p) AS most, any_value(a) AS a FROM share, al),
quota AS (SELECT tot.s, tot.t, coalesce(pow(p, a) / z, 0) AS weight, coalesce(pow(p, a) / z * ((SELECT sum(t) FROM tot) * pow(most, 1 - a) * z) / tot.t + 1e-9, 1.0) AS r FROM tot LEFT JOIN share USING (s), zz),
q AS (SELECT *, floor(r)::BIGINT AS whole, floor((r - floor(r)) * t)::BIGINT AS rest FROM quota),
b AS (SELECT *, unnest(range(0, whole + 1)) AS block FROM tok JOIN q USING (s)),
k AS (SELECT *, {key('block')} AS order_key FROM b),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY s, block ORDER BY order_key, n_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM k)
SELECT doc_id, source, n_tokens, block::INTEGER AS block, order_key, round(weight, 6) AS weight FROM run WHERE block < whole OR (rest > 0 AND upto <= rest)"""


def _op9_sql() -> str:
    kinds = {
        "assign": (r"""((?i:password|passwd|secret|token|api_?key))["\']?\x20*[:=]\x20*["\']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        "access": (r"AKIA[A-Z0-9]+", 0, 20),
        "hex": (r"[0-9a-f]+", 0, 24),
        "random": (r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20),
    }
    quoted = lambda p: p.replace("\\'", "''")
    found = " UNION ALL ".join(f"SELECT r, {i} AS kind, {least} AS least, string_split_regex(t, '{quoted(p)}') AS p, regexp_extract_all(t, '{quoted(p)}', 0) AS h, regexp_extract_all(t, '{quoted(p)}', {group}) AS s FROM doc" for i, (p, group, least) in enumerate(kinds.values()))
    name = "['assign', 'access', 'hex', 'random'][kind + 1]"
    tail = lambda z: f"(1 / (1 + exp(1.5976 * greatest(-8.0, least(8.0, {z})) + 0.07056 * pow(greatest(-8.0, least(8.0, {z})), 3))))"
    far = lambda p: f"tan((0.5 - greatest(1e-12, least(1 - 1e-12, {p}))) * pi())"
    text = lambda of: f"string_agg({name} || ':' || a || ':' || z, ',' ORDER BY a, kind, z) FILTER (WHERE {of})"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
part AS (SELECT r, kind, least, unnest(p[:len(h)]) AS p, unnest(h) AS h, unnest(s) AS s, unnest(range(len(h))) AS i FROM ({found})),
hit AS (SELECT r, kind, h, z - length(h) AS a, z FROM (SELECT *, sum(length(p) + length(h)) OVER (PARTITION BY r, kind ORDER BY i) AS z FROM part) WHERE length(s) >= least),
base AS (SELECT * FROM hit WHERE kind < 3),
bare AS (SELECT *, rtrim(h, '=') AS b FROM hit WHERE kind = 3),
named AS (SELECT *, CASE WHEN NOT (regexp_matches(b, '[0-9]') AND regexp_matches(b, '[A-Za-z]')) THEN NULL WHEN regexp_full_match(b, '[0-9a-f]+|[0-9A-F]+') THEN 'hex' WHEN regexp_full_match(b, '[A-Z2-7]+') THEN 'base32' WHEN regexp_full_match(b, '[a-z0-9]+|[A-Z0-9]+') THEN 'base36' WHEN regexp_full_match(b, '[A-Za-z0-9]+') THEN 'base62' ELSE 'base64' END AS enc FROM bare),
coded AS (SELECT *, length(t)::DOUBLE AS n, length(abc)::DOUBLE AS k, list_transform(string_split(t, ''), lambda x: instr(abc, x)::DOUBLE) AS c FROM (SELECT *, CASE WHEN enc IN ('hex', 'base36') THEN lower(b) ELSE translate(b, '-_', '+/') END AS t,
    CASE enc WHEN 'hex' THEN '0123456789abcdef' WHEN 'base32' THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' WHEN 'base36' THEN '0123456789abcdefghijklmnopqrstuvwxyz' WHEN 'base62' THEN '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz' ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END AS abc FROM named WHERE enc IS NOT NULL)),
summed AS (SELECT *, list_sum(list_transform(string_split(abc, ''), lambda x: pow(n - length(replace(t, x, '')), 2))) AS squares, list_sum(c) / n AS m, len(list_filter(c, lambda v: v > k / 2))::DOUBLE AS high, list_zip(c[:-2], c[2:]) AS uv FROM coded),
tested AS (SELECT *, 1.0 + len(list_filter(uv, lambda x: (x[1] > k / 2) <> (x[2] > k / 2))) AS turns, list_sum(list_transform(uv, lambda x: (x[1] - m) * (x[2] - m))) AS up, list_sum(list_transform(c, lambda v: (v - m) * (v - m))) AS down, 2 * high * (n - high) AS mix FROM summed),
judged AS (SELECT r, kind, a, z, enc, t, floor(ln(n) / ln(2) * 2)::INTEGER AS size, 0.5 - atan(({far(tail('(k / n * squares - n - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n)'))} + {far('2 * ' + tail('abs(CASE WHEN mix > 0 THEN (turns - mix / n - 1) / sqrt(greatest(mix * (mix - n) / (n * n * (n - 1)), 1e-9)) ELSE 9.0 END)'))}
    + {far('2 * ' + tail('abs((CASE WHEN down > 0 THEN up / down ELSE 1.0 END + 1 / n) * sqrt(n))'))}) / 3) / pi() AS p FROM tested),
bin AS (SELECT enc, size, least(floor(p * 20)::INTEGER, 19) AS bin FROM (SELECT enc, size, t, any_value(p) AS p FROM judged GROUP BY ALL)),
class AS (SELECT enc, size, count(*) AS total, least(1.0, count(*) FILTER (WHERE bin >= 10) / 0.5 / count(*)) * count(*) AS random FROM bin GROUP BY ALL),
step AS (SELECT enc, size, random, i, (SELECT count(*) FROM bin WHERE bin.enc = class.enc AND bin.size = class.size AND bin.bin >= i) AS above FROM class, range(11) AS g(i)),
least_p AS (SELECT enc, size, greatest(min(i) / 20.0, 0.01) AS least_p FROM step WHERE above > 0 AND greatest(0.0, above - random * (1 - i / 20.0)) / above <= 0.1 GROUP BY ALL),
more AS (SELECT r, kind, a, z FROM judged JOIN least_p USING (enc, size) WHERE p >= least_p AND NOT EXISTS (SELECT 1 FROM base WHERE base.r = judged.r AND base.a < judged.z AND judged.a < base.z)),
span AS (SELECT r, kind, a::BIGINT AS a, z::BIGINT AS z FROM base UNION ALL SELECT r, kind, a::BIGINT, z::BIGINT FROM more),
said AS (SELECT r, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex, {text('kind < 3')} AS base, {text('TRUE')} AS spans FROM span GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM doc LEFT JOIN said USING (r)"""


def _op11_sql() -> str:
    base = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "TRUE"),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(h, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(TRY_CAST(x AS INTEGER), 0) > 255)) = 0"),
        "card": (r"[0-9]([\x20-]?[0-9])+", "length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN d[-i]::INTEGER WHEN d[-i]::INTEGER > 4 THEN 2 * d[-i]::INTEGER - 9 ELSE 2 * d[-i]::INTEGER END)) % 10 = 0"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15"),
    }
    iban, local = r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}"
    kinds = [*base, "iban", "local"]
    found = " UNION ALL ".join(f"SELECT r, t, {i} AS kind, string_split_regex(t, '{p}') AS p, regexp_extract_all(t, '{p}') AS h FROM doc" for i, p in enumerate([*(p for p, _ in base.values()), iban, local]))
    holds = "CASE kind " + " ".join(f"WHEN {i} THEN {ok}" for i, (_, ok) in enumerate(base.values())) + " END"
    sizes = "CASE h[1:2] " + " ".join(f"WHEN '{c}' THEN {n}" for c, n in pii.IBAN_LENGTHS.items()) + " END"
    value = lambda c: f"(CASE WHEN {c} BETWEEN '0' AND '9' THEN {c}::INTEGER ELSE ascii({c}) - 55 END)"
    beside = "NOT regexp_matches(substr(t, a::BIGINT, CASE WHEN a > 0 THEN 1 ELSE 0 END) || substr(t, z::BIGINT + 1, 1), '[A-Za-z0-9]')"
    speaks = "CASE kind " + " ".join(f"WHEN {i} THEN regexp_matches(near, '(^|[^a-z])({words})([^a-z]|$)')" for i, words in enumerate(["email|e-mail|mail|contact|write", "ip|host|server|address|login", "card|visa|mastercard|amex|credit|debit|payment", "phone|tel|telephone|call|mobile|cell|fax|whatsapp", "iban|account|bank|transfer", "phone|tel|telephone|call|mobile|cell|fax|whatsapp"])) + " END"
    name = "['email', 'ip', 'card', 'phone', 'iban', 'local'][kind + 1]"
    text = lambda of: f"string_agg({name} || ':' || a || ':' || z, ',' ORDER BY kind, a) FILTER (WHERE {of})"
    return f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
part AS (SELECT r, t, kind, unnest(p[:len(h)]) AS p, unnest(h) AS h, unnest(range(len(h))) AS i FROM ({found}) WHERE len(h) > 0),
hit AS (SELECT *, regexp_replace(h, '[^0-9]', '', 'g') AS d, z - length(h) AS a FROM (SELECT *, sum(length(p) + length(h)) OVER (PARTITION BY r, kind ORDER BY i) AS z FROM part)),
base AS (SELECT r, t, kind, a, z FROM hit WHERE kind < 4 AND {holds}),
bank AS (SELECT r, t, 4 AS kind, a, a + place[n] AS z, list_transform(place[:n], lambda i: h[i]) AS c FROM (SELECT *, {sizes} AS n, list_filter(range(1, length(h) + 1), lambda i: h[i] <> ' ') AS place FROM hit WHERE kind = 4) WHERE n <= len(place)),
more AS (SELECT r, t, kind, a, z FROM bank WHERE {beside} AND list_reduce(list_transform(c[5:] || c[:4], lambda x: {value('x')}), lambda acc, v: (acc * CASE WHEN v < 10 THEN 10 ELSE 100 END + v) % 97, 0) = 1
    UNION ALL SELECT r, t, kind, a, z FROM hit WHERE kind = 5 AND {beside}),
scored AS (SELECT *, least(100, greatest(0, [90, 60, 80, 70, 90, 40][kind + 1] + 30 * ({speaks})::INTEGER - 30 * regexp_matches(near, '(^|[^a-z])(isbn|issn|version|order|invoice|sku|example|test)([^a-z]|$)')::INTEGER)) AS score
    FROM (SELECT *, translate(substr(t, greatest(a - 39, 1)::BIGINT, least(a, 40)::BIGINT) || chr(10) || substr(t, z::BIGINT + 1, 40), '{UPPER}', '{LOWER}') AS near FROM (SELECT * FROM base UNION ALL SELECT * FROM more))),
span AS (SELECT r, kind, a::BIGINT AS a, z::BIGINT AS z, score FROM scored s WHERE kind < 4 OR score >= 50 AND NOT EXISTS (SELECT 1 FROM scored b WHERE b.r = s.r AND b.kind < s.kind AND (b.kind < 4 OR b.score >= 50) AND b.a < s.z AND s.a < b.z)),
said AS (SELECT r, {', '.join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(kinds[:4]))}, {text('kind < 4')} AS base, {text('TRUE')} AS spans, string_agg(score::VARCHAR, ',' ORDER BY kind, a) AS scores FROM span GROUP BY r)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds[:4])}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM doc LEFT JOIN said USING (r)"""


def _op12_sql() -> str:
    letters = "(VALUES ('A'), ('B'), ('C'), ('D'), ('E'))"
    return f"""
WITH doc AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS first FROM doc GROUP BY t),
says AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
judged AS (SELECT part, good, toxic, (len(w) < 200)::INTEGER + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INTEGER + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t))::INTEGER
    + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER + 16 * coalesce(doc_id > first, FALSE)::INTEGER AS mask FROM doc JOIN first USING (t) LEFT JOIN says USING (doc_id)),
n AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x FROM judged GROUP BY part, mask),
o AS (SELECT a.l || b.l || c.l || d.l || e.l AS o FROM {letters} a(l), {letters} b(l), {letters} c(l), {letters} d(l), {letters} e(l) WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
bits AS (SELECT o, s, (1 << (ascii(o[s]) - 65))::INTEGER AS bit, list_sum(list_transform(range(1, s), lambda i: 1 << (ascii(o[i]) - 65)))::INTEGER AS before FROM o, range(1, 6) AS r(s)),
cell AS (SELECT part, o, s, bit, coalesce(sum(n) FILTER (WHERE mask & bit = 0 AND mask & coalesce(before, 0) = 0), 0) AS kept, coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) = 0), 0) AS removed, coalesce(sum(n) FILTER (WHERE mask & bit > 0 AND mask & before > 0), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS alone, coalesce(sum(g) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) = 0), 0) AS good, coalesce(sum(x) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) = 0), 0) AS toxic FROM n, bits GROUP BY ALL)
SELECT part, o AS filter_order, s::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, alone::BIGINT AS unique_fails, good::BIGINT AS good_lost, toxic::BIGINT AS toxic_lost, sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM cell"""


def _op13_sql() -> str:
    return """
WITH RECURSIVE one AS (SELECT click_id, min(struct_pack(us := epoch_us(ts), client_id := client_id, late := coalesce(epoch_us(arrived_at) - epoch_us(ts) > 3600000000, FALSE), final := coalesce(kind = 'purchase' AND value >= 60, FALSE),
    cents := CASE WHEN value IS NULL OR NOT isfinite(value) THEN 0 ELSE floor(100 * value + 0.5)::BIGINT END)) AS x FROM clicks WHERE click_id IS NOT NULL AND client_id IS NOT NULL AND ts IS NOT NULL GROUP BY click_id),
click AS (SELECT click_id, x.us AS us, x.client_id AS c, x.late AS late, x.final AS final, x.cents AS cents FROM one),
timely AS (SELECT *, row_number() OVER w AS k, CASE WHEN lag(final) OVER w IS NULL THEN 'first' WHEN lag(final) OVER w THEN 'end' WHEN us - lag(us) OVER w >= 300000000 THEN 'gap' END AS sure FROM click WHERE NOT late WINDOW w AS (PARTITION BY c ORDER BY us, click_id)),
isle AS (SELECT *, count(sure) OVER (PARTITION BY c ORDER BY k) AS isle FROM timely),
nxt AS (SELECT a.c, a.k, min(b.k) AS n FROM isle a JOIN isle b ON a.c = b.c AND a.isle = b.isle AND b.us > a.us + 7200000000 GROUP BY a.c, a.k),
head(c, k, why) AS (SELECT c, k, sure FROM isle WHERE sure IS NOT NULL UNION ALL SELECT head.c, n, 'length' FROM head JOIN nxt ON nxt.c = head.c AND nxt.k = head.k),
mark AS (SELECT isle.*, why, count(why) OVER (PARTITION BY c ORDER BY k) AS s FROM isle LEFT JOIN head USING (c, k)),
sess AS (SELECT c, s, arg_min(click_id, k) AS id, min(us) AS a, max(us) AS z, count(*) AS n, sum(cents) AS cents, arg_max(final, k) AS final, min(why) AS why, string_agg(click_id::VARCHAR, ',' ORDER BY k) AS path FROM mark GROUP BY c, s),
chain AS (SELECT *, lead(a) OVER w AS next_a, lead(why) OVER w AS reason FROM sess WINDOW w AS (PARTITION BY c ORDER BY s)),
tardy AS (SELECT chain.c, s, count(*) AS n_late FROM chain JOIN click ON click.c = chain.c AND late AND us >= a AND (next_a IS NULL OR us < next_a) GROUP BY chain.c, s)
SELECT c AS client_id, id AS session_id, a AS start_us, z AS end_us, n AS n_clicks, coalesce(n_late, 0) AS n_late, cents::BIGINT AS value_cents, coalesce(reason, CASE WHEN final THEN 'end' ELSE 'none' END) AS closed_by, sha256(path) AS path_sha256 FROM chain LEFT JOIN tardy USING (c, s)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_url_reputation": _op1_sql(), "op2_line_frequency": _op2_sql(), "op3_decontaminate": _op3_sql(), "op4_substring_dedup": _op4_sql(), "op5_jaccard_join": _op5_sql(), "op7_mixing": _op7_sql(), "op9_secrets": _op9_sql(), "op11_pii": _op11_sql(), "op12_filter_audit": _op12_sql(), "op13_gap_sessions": _op13_sql()}
