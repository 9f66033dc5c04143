"""One query for each operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskmill.llm import huffman
from deskmill.llm.decontaminate import contamination
from deskmill.llm.divergence import divergence
from deskmill.llm.language import languages
from deskmill.llm.lm_scores import entropy_difference
from deskmill.llm.manifest import manifest
from deskmill.llm.mixing import mixture
from deskmill.llm.near_dedup import near_duplicates
from deskmill.llm.packing import pack, tokenizer_path
from deskmill.llm.pages import main_text
from deskmill.llm.pii import personal_data
from deskmill.llm.quality import quality
from deskmill.llm.secrets import secrets
from deskmill.session import spread_table, table

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def register(job):
        QUERIES[name] = job
        if check is not None:
            CHECKS[name] = check
        return job

    return register


@query(
    "op1_minhash_near_dedup",
    r"""WITH RECURSIVE words AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN len(w) >= 2
                   THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                   ELSE w END AS s FROM words),
        classes AS (SELECT min(doc_id) AS node, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
        rows AS (SELECT node, len(s) AS n, unnest(s) AS g FROM classes),
        shared AS (
          SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS both_n
          FROM rows a JOIN rows b ON a.g = b.g AND a.node < b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
          GROUP BY a.node, b.node),
        links AS (SELECT a, b FROM shared WHERE 100 * both_n >= 80 * (na + nb - both_n)),
        both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(node, seen) AS (
          SELECT node, node FROM classes
          UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a),
        named AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
        SELECT t.doc_id, CAST(len(t.s) AS BIGINT) AS n_shingles,
               coalesce(n.component, t.doc_id) AS component_id,
               t.doc_id = coalesce(n.component, t.doc_id) AS kept
        FROM sets t LEFT JOIN classes c ON list_sort(t.s) = c.s LEFT JOIN named n ON n.node = c.node""",
)
def op1_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(spread_table(spark, sf_dir, "documents"), words=2)


@query("op6_nnls_packing")
def op6_nnls_packing(spark, sf_dir):
    return pack(spread_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op9_huffman_token_ids")
def op9_huffman_token_ids(spark, sf_dir):
    return huffman.round_trip(spread_table(spark, sf_dir, "documents"), tokenizer_path())


@query(
    "op8_winnowing_decontamination",
    r"""WITH lowered(kind, id, text) AS (
          SELECT 'd', doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM documents
          UNION ALL
          SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
        words AS (SELECT kind, id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered),
        item_windows AS (
          SELECT DISTINCT id AS item_id, least(10, len(w)) AS size,
                 unnest(list_transform(range(1, greatest(2, len(w) - 8)), lambda i: array_to_string(w[i:i + 9], ' '))) AS g
          FROM words WHERE kind = 'b' AND len(w) > 0),
        sizes AS (SELECT DISTINCT size FROM item_windows),
        doc_windows AS (
          SELECT id AS doc_id, size, unnest(range(1, CAST(len(w) AS BIGINT) - size + 2)) AS i, w
          FROM words, sizes WHERE kind = 'd' AND len(w) >= size),
        found AS (
          SELECT d.doc_id, d.size, d.i, b.item_id
          FROM doc_windows d JOIN item_windows b
            ON d.size = b.size AND array_to_string(d.w[d.i:d.i + d.size - 1], ' ') = b.g),
        hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
        named AS (
          SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
        SELECT t.id AS doc_id, CAST(len(t.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
               coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
               coalesce(h.n_hit, 0) > 0 AS contaminated
        FROM words t LEFT JOIN hit h ON h.doc_id = t.id LEFT JOIN named n ON n.doc_id = t.id
        WHERE t.kind = 'd'""",
)
def op8_winnowing_decontamination(spark, sf_dir):
    return contamination(spread_table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_secret_ownership")
def op10_secret_ownership(spark, sf_dir):
    return secrets(spread_table(spark, sf_dir, "documents"))


@query("op5_weakly_supervised_pii")
def op5_weakly_supervised_pii(spark, sf_dir):
    return personal_data(spread_table(spark, sf_dir, "documents"))


@query("op7_dom_tree_main_text")
def op7_dom_tree_main_text(spark, sf_dir):
    return main_text(spread_table(spark, sf_dir, "pages"))


@query("op2_crf_language_id")
def op2_crf_language_id(spark, sf_dir):
    return languages(spread_table(spark, sf_dir, "documents"))


@query("op3_kneser_ney_quality")
def op3_kneser_ney_quality(spark, sf_dir):
    return quality(spread_table(spark, sf_dir, "documents"))


@query("op4_cross_entropy_difference")
def op4_cross_entropy_difference(spark, sf_dir):
    good = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return entropy_difference(spread_table(spark, sf_dir, "documents"), good)


@query(
    "op11_skyband_source_divergence",
    r"""WITH texts AS (
          SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        words AS (SELECT d, lang, source, unnest(w) AS term FROM texts),
        kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
        counts AS (
          SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
          GROUP BY w.lang, w.source, w.term),
        langs AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS total, count(*) AS v FROM kept GROUP BY lang),
        totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM counts GROUP BY lang, source),
        groups AS (
          SELECT g.lang, g.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v
          FROM (SELECT DISTINCT lang, source FROM texts) g
          LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source LEFT JOIN langs l ON l.lang = g.lang),
        dense AS (
          SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
                 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (g.total + g.v) AS p
          FROM groups g JOIN kept k ON k.lang = g.lang
          LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        sums AS (
          SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
          FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY a.lang, a.source, b.source),
        pairs AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        chances AS (
          SELECT d.lang, d.source, d.term, d.p, 1 + (CAST(1000000000 AS HUGEINT) * (d.lang_n + 1)) // (l.total + l.v) AS q
          FROM dense d JOIN langs l ON l.lang = d.lang WHERE d.n > 0),
        terms AS (
          SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
          FROM chances WHERE p > q),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
          FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
)
def op11_skyband_source_divergence(spark, sf_dir):
    return divergence(spread_table(spark, sf_dir, "documents"))


@query(
    "op12_interval_merkle_manifest",
    r"""WITH RECURSIVE fields AS (
          SELECT doc_id, source,
                 coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
                   || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
                 text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
                 xor(list_reduce(
                   list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
                     string_split(CAST(doc_id AS VARCHAR), ''),
                     lambda c: list_concat([CAST(ascii(c) AS BIGINT)], list_transform(range(8), lambda i: CAST(-1 AS BIGINT)))))),
                   lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END),
                   CAST(4294967295 AS BIGINT)) AS crc
          FROM documents),
        digests AS (
          SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                 CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(small) || ':' || small, '-')) END AS altered
          FROM fields),
        leaves AS (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                 count(*) OVER (PARTITION BY source) AS n FROM digests),
        nodes(source, level, i, n, digest) AS (
          SELECT source, 0, place, n, leaf FROM leaves
          UNION ALL
          SELECT source, any_value(level) + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
          FROM nodes WHERE n > 1 GROUP BY source, i // 16),
        subroots AS (
          SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
          FROM nodes WHERE n = 1),
        tops(level, i, n, digest) AS (
          SELECT 0, place, n, digest FROM subroots
          UNION ALL
          SELECT any_value(level) + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
          FROM tops WHERE n > 1 GROUP BY i // 16),
        root AS (SELECT digest AS root FROM tops WHERE n = 1),
        runs AS (
          SELECT source, level, i,
                 coalesce(string_agg(digest, '' ORDER BY i) FILTER (WHERE i < me), '') AS before,
                 coalesce(string_agg(digest, '' ORDER BY i) FILTER (WHERE i > me), '') AS after, me
          FROM (SELECT a.source, a.level, a.i AS me, b.i, b.digest FROM nodes a
                JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.i // 16 = b.i // 16 WHERE a.n > 1)
          GROUP BY source, level, me, i),
        steps AS (
          SELECT source, level, me, string_agg(before, '' ORDER BY i) AS before, string_agg(after, '' ORDER BY i) AS after
          FROM runs GROUP BY source, level, me),
        top_steps AS (
          SELECT a.level, a.i AS me, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
                 coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
          FROM tops a JOIN tops b ON a.level = b.level AND a.i // 16 = b.i // 16 WHERE a.n > 1 GROUP BY a.level, a.i),
        paths AS (
          SELECT l.source, l.place, s.level, s.before, s.after
          FROM leaves l JOIN steps s ON s.source IS NOT DISTINCT FROM l.source AND s.me = l.place >> (4 * s.level)
          UNION ALL
          SELECT l.source, l.place, 100 + t.level, t.before, t.after
          FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source
          JOIN top_steps t ON t.me = r.place >> (4 * t.level)),
        folds AS (
          SELECT source, place, string_agg(before || after, '' ORDER BY level) AS proof,
                 list(before || ',' || after ORDER BY level) AS runs FROM paths GROUP BY source, place),
        found AS (
          SELECT l.doc_id, l.leaf, r.digest AS subroot, root.root, sha256(coalesce(f.proof, '')) AS proof_sha256,
                 list_reduce(list_concat([coalesce(l.altered, l.leaf)], coalesce(f.runs, [])),
                   lambda acc, x: sha256(split_part(x, ',', 1) || acc || split_part(x, ',', 2))) AS folded_root
          FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source CROSS JOIN root
          LEFT JOIN folds f ON f.source IS NOT DISTINCT FROM l.source AND f.place = l.place)
        SELECT *, folded_root = root AS verified FROM found""",
)
def op12_interval_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return manifest(spread_table(spark, sf_dir, "documents"), tampered)


@query(
    "op13_curriculum_mixture",
    r"""WITH sized AS (
          SELECT doc_id, coalesce('s' || source, 't') AS origin,
                 CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS BIGINT) AS size FROM documents),
        sources AS (
          SELECT origin, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY origin) - 1 AS place
          FROM sized GROUP BY origin),
        weighed AS (
          SELECT origin, source_size, CAST(3 * source_size AS HUGEINT) AS most,
                 CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources),
        ordered AS (
          SELECT *, coalesce(sum(most) OVER w, 0) AS mosts, coalesce(sum(weight) OVER w, 0) AS weights,
                 sum(source_size) OVER () AS whole, sum(weight) OVER () AS all_weights
          FROM weighed WINDOW w AS (ORDER BY most / weight, origin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        judged AS (SELECT *, most * (all_weights - weights) < (whole - mosts) * weight AS is_full FROM ordered),
        rest AS (
          SELECT max(whole) - coalesce(sum(most) FILTER (WHERE is_full), 0) AS words,
                 greatest(1, coalesce(sum(weight) FILTER (WHERE NOT is_full), 0)) AS weights FROM judged),
        targets AS (
          SELECT j.origin, j.source_size,
                 CASE WHEN j.is_full THEN CAST(j.most AS DOUBLE)
                      ELSE CAST(r.words * j.weight AS DOUBLE) / CAST(r.weights AS DOUBLE) END AS target
          FROM judged j CROSS JOIN rest r),
        placed AS (
          SELECT s.*, t.source_size, t.target,
                 coalesce(sum(s.size) OVER (PARTITION BY s.origin
                   ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '')), s.doc_id NULLS FIRST, s.size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before
          FROM sized s JOIN targets t ON t.origin = s.origin)
        SELECT doc_id, size, source_size, target,
               CAST(list_sum(list_transform([0, 1, 2], lambda i:
                 greatest(0, least(size, CAST(floor(target) AS BIGINT) - i * source_size - words_before)))) AS BIGINT) AS taken
        FROM placed""",
)
def op13_curriculum_mixture(spark, sf_dir):
    return mixture(spread_table(spark, sf_dir, "documents"))
