"""Registered queries of the pipeline operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslab.llm import (
    collocations, embedding_dedup, exact_dedup, language_id, packing, quality, sentencepieces, simhash, spelling, substring_dedup,
    toxicity, url_filter, warc,
)

ALLOW = ["org/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]
ALLOW_BELOW = ["com/fr/"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document: their number and CRC, and whether decoding gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepieces.checked_pieces(table(spark, sf_dir, "documents"), model)


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit_languages(docs.where(~F.coalesce(held_out, F.lit(False))))
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return language_id.identify_languages(rows, model, carry=["held_out"])


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), [*ALLOW, *ALLOW_BELOW], BLOCK)


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return packing.packed_documents(
        table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document (0 toxic, 1 poor, 2 good) and the probability of grade 2."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_ratings(docs, table(spark, sf_dir, "labels"))
    graded = quality.grade_documents(docs.select("doc_id", "text"), model, keep_grade=2)
    return graded.select("row.doc_id", "expected_grade", "tail", "kept")


def op10_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four fifths of the identifiers."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_labels(docs, labels.where(~toxicity.held_out()))
    rows = docs.select("doc_id", "text", toxicity.held_out().alias("held_out"))
    return toxicity.score_toxicity(rows, model, carry=["held_out"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f for f in (
        op1_sentencepiece, op2_embedding_near_dedup, op3_exact_dedup, op4_language_id, op5_url_filter, op6_warc_revisits,
        op7_substring_dedup, op8_best_fit_packing, op9_quality_classifier, op10_simhash_golay, op11_phrase_collocations,
        op12_spelling_variants, op13_toxicity, pipeline,
    )
}

ORACLE = {
    "op2_embedding_near_dedup": """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
 ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
   AND len(list_filter(e, lambda x: x <> 0)) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e)
   AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
 reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
 root AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
 n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
 SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(root.m, v.vec_id)) AS component_id,
   v.vec_id = least(v.vec_id, coalesce(root.m, v.vec_id)) AS kept
 FROM v LEFT JOIN n ON n.a = v.vec_id LEFT JOIN root ON root.a = v.vec_id""",
    "op3_exact_dedup": r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
 SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
   row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
 FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)""",
    "op5_url_filter": r"""WITH r(rule, host, path, verdict) AS (VALUES ('org/', 'org', '/', 'allow'),
   ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
   ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
 s AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
 u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
   AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
 m AS (SELECT page_id, rule, verdict FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host))
   AND starts_with(u.path, r.path) QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) = 1)
 SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (page_id)""",
    "op6_warc_revisits": r"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
 d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
 five AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(x, 1 + 5 * i::INT, 5))::BIGINT) AS g FROM d)
 SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(list_transform(g, lambda v:
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (v // 32768)::INT] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (v // 1024 % 32)::INT]
   || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (v // 32 % 32)::INT] || 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (v % 32)::INT]), '')
   AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
   CASE WHEN page_id <> first THEN first END AS refers_to FROM five""",
    "op11_phrase_collocations": r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 s AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
 g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
   FROM s, range(1, 5) t(k) WHERE len(w) >= k),
 f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM g GROUP BY ALL),
 nl AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
 c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
 cut AS (SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, 2000000 * c.a // (x.a + y.a) AS score
   FROM c, range(1, 4) t(j) JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
   JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ') WHERE j < c.k),
 best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
 ins AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM c, range(2, 4) t(m), range(1, 4) u(i)
   WHERE m < k AND i + m - 1 <= k),
 gone AS (SELECT lang, phrase, max(a) AS longer FROM ins GROUP BY ALL),
 kept AS (SELECT best.* FROM best LEFT JOIN gone USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
 o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
 SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
 FROM o JOIN nl USING (lang) WHERE rank <= 2000""",
    "op12_spelling_variants": r"""WITH RECURSIVE tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
   lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
 r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
   'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
 d AS (SELECT doc_id, run, count(*) AS c, hex(encode(doc_id::VARCHAR || ':' || run)) AS x FROM r GROUP BY ALL),
 h AS (SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(x) // 2),
   lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)), lambda a, b: xor(tab.t[(xor(a, b) & 255) + 1], a >> 8))) AS h FROM d, tab),
 v AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
   FROM h),
 w AS (SELECT word, sum(c)::BIGINT AS n FROM v WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
 del AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM w, range(1, 1000) t(i) WHERE i <= length(word)),
 near AS (SELECT a.word, b.word AS other, b.n FROM del a JOIN del b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
   UNION SELECT del.word, w.word, w.n FROM del JOIN w ON del.d = w.word
   UNION SELECT w.word, del.word, del.n FROM del JOIN w ON del.d = w.word),
 cnt AS (SELECT word, count(*) AS n_near FROM near GROUP BY word),
 best AS (SELECT word, other, n AS form_n FROM near QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
 f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN other END AS form,
   CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM w LEFT JOIN cnt USING (word) LEFT JOIN best USING (word)),
 walk(word, root) AS (SELECT word, word FROM f UNION SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root
   WHERE f.form IS NOT NULL)
 SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n FROM f JOIN walk USING (word) JOIN f e ON e.word = walk.root
 WHERE e.form IS NULL""",
}
