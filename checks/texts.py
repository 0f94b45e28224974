"""Text functions, tokens, vocabulary, TF-IDF, naive Bayes, digests, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import ARTICLES, SPLIT, articles, normalized, split_documents, table
from corpuslab.functions import text as tx
from corpuslab.functions.columns import canonical_name, slug
from corpuslab.functions.labels import decode, encode, label_domain
from corpuslab.operators import features as ft
from corpuslab.operators.encoding import content_digest
from corpuslab.plans.studies import nb_study
from corpuslab.session import deal, materialize, scratch_path, spread
from corpuslab.sources.tables import read_table, write_table, write_verified

STOP = ["the", "and", "la", "de", "le", "und"]
TEMPLATE = "T: {TITLE}\nD: {DESCRIPTION}\nA: {ARTICLE}"


def clean_text_functions(spark, d):
    pages = spread(table(spark, d, "pages"), "page_id")
    return pages.select(
        "page_id",
        tx.normalize_text("html").alias("normalized"),
        tx.clean_headline(F.concat("url", F.lit(" <b>x</b> - Wire \n")), "wire").alias("headline"),
        tx.clean_body(F.concat(F.lit("PARIS (WIRE) - "), "html"), "WIRE").alias("body"),
        canonical_name("url").alias("name"),
        slug("url").alias("slug"),
    )


def combined_texts(spark, d):
    a = articles(spark, d)
    return a.select(
        "id",
        F.md5(tx.baseline_text("headline", "description", "body")).alias("baseline"),
        F.md5(tx.enhanced_text("headline", "description", "body", "WIRE")).alias("enhanced"),
        F.md5(tx.topic_text("headline", "description")).alias("topic"),
    )


def prompt_build(spark, d):
    a = articles(spark, d)
    prompt = tx.fill_template(
        TEMPLATE, TITLE=tx.clean_text("headline"), DESCRIPTION=tx.clean_text("description"),
        ARTICLE=tx.truncate_text(tx.clean_text("body"), 400),
    )
    return a.select("id", F.md5(prompt).alias("prompt_md5"), F.length(prompt).alias("prompt_length"))


def _docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id")


def token_counts(spark, d):
    return ft.token_counts(ft.tokenize(deal(_docs(spark, d), "doc_id"), "text"), "doc_id")


def token_ngrams(spark, d):
    """Words and word pairs; a pair may span a removed stop word."""
    tokens = ft.tokenize(deal(_docs(spark, d), "doc_id"), "text", stop=STOP, ngrams=(1, 2))
    return ft.token_counts(tokens, "doc_id").groupBy("term").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs")
    )


def topic_tokens(spark, d):
    tokens = ft.tokenize(_docs(spark, d), "text", pattern=ft.TOPIC_TOKEN, stop=STOP)
    return tokens.select("doc_id", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


def vocabulary(spark, d):
    tokens = ft.tokenize(_docs(spark, d), "text")
    return ft.fit_vocabulary(tokens, min_df=5, max_df=0.95)


def tfidf_long(spark, d):
    tokens = ft.tokenize(_docs(spark, d), "text")
    model = materialize(ft.tfidf_fit(tokens), "vocabulary")
    dealt = ft.tokenize(deal(_docs(spark, d), "doc_id"), "text")
    weights = ft.tfidf_transform(dealt, "doc_id", model)
    return weights.select("doc_id", "term_idx", F.round("weight", 6).alias("weight"))


def nb_predictions(spark, d):
    docs = split_documents(spark, d).select("doc_id", "text", "lang", "split")
    return nb_study(docs, "doc_id", "text", "lang")


def label_encoding(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    domain = label_domain(docs, "lang")
    coded = docs.withColumn("code", encode("lang", domain))
    return coded.select("doc_id", "code", decode("code", domain).alias("decoded"))


def digest(spark, d):
    return content_digest(table(spark, d, "documents"), "doc_id", "text")


def csv_roundtrip(spark, d):
    """Whole documents through a CSV file with quoted line breaks."""
    docs = table(spark, d, "documents")
    path = scratch_path(spark, "docs") + ".csv"
    write_table(docs, path)
    back = read_table(spark, path, docs.schema, multi_line=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars")


def write_and_verify(spark, d):
    """Parquet write, read back, compared; then counted."""
    back = write_verified(table(spark, d, "pages"), scratch_path(spark, "pages"))
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("html")).alias("characters"))


_NORM = normalized("html")
_TF = r"""tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
 occ AS (SELECT doc_id, term, count(*) AS n FROM tok GROUP BY ALL)"""
_SCRIPT = {
    "stop": ", ".join(f"'{s}'" for s in STOP),
}

QUERIES = {
    "clean_text_functions": clean_text_functions, "combined_texts": combined_texts, "prompt_build": prompt_build,
    "token_counts": token_counts, "token_ngrams": token_ngrams, "topic_tokens": topic_tokens,
    "vocabulary": vocabulary, "tfidf_long": tfidf_long, "nb_predictions": nb_predictions,
    "label_encoding": label_encoding, "content_digest": digest, "csv_roundtrip": csv_roundtrip,
    "write_and_verify": write_and_verify,
}

_PARTS = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
_H, _D, _B = (_PARTS.format(c=c) for c in ("headline", "description", "body"))
_NL = "chr(10)"

ORACLE = {
    "clean_text_functions": rf"""SELECT page_id, {_NORM} AS normalized,
      trim(regexp_replace({normalized("(url || ' <b>x</b> - Wire ' || chr(10))")}, '(?i)\s*-\s*wire\s*$', '')) AS headline,
      trim(regexp_replace({normalized("('PARIS (WIRE) - ' || html)")}, '^[A-Z][A-Za-z .''-]+\s*\(WIRE\)\s*[-—:]?\s*', '')) AS body,
      regexp_replace(regexp_replace(lower(trim(url)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS name,
      regexp_replace(regexp_replace(lower(url), '[^\p{{L}}\p{{N}}]', '_', 'g'), '^_+|_+$', '', 'g') AS slug
      FROM pages""",
    "combined_texts": f"""WITH {ARTICLES} SELECT id,
      md5(array_to_string(list_filter([{_H}, {_D}, {_B}], lambda x: x <> ''), {_NL} || {_NL})) AS baseline,
      md5(array_to_string(list_filter([
        trim(regexp_replace({normalized('headline')}, '(?i)\\s*-\\s*WIRE\\s*$', '')), {normalized('description')},
        trim(regexp_replace({normalized('body')}, '^[A-Z][A-Za-z .''-]+\\s*\\(WIRE\\)\\s*[-—:]?\\s*', ''))],
        lambda x: x <> ''), '. ')) AS enhanced,
      md5(array_to_string(list_filter([{_H}, {_D}], lambda x: x <> ''), '. ')) AS topic FROM a""",
    "prompt_build": f"""WITH {ARTICLES}, p AS (SELECT id, 'T: ' || {_H} || {_NL} || 'D: ' || {_D} || {_NL} || 'A: ' ||
      CASE WHEN length({_B}) > 400 THEN regexp_replace(substring({_B}, 1, 400), '\\s+$', '') ELSE {_B} END AS prompt FROM a)
      SELECT id, md5(prompt) AS prompt_md5, length(prompt)::INT AS prompt_length FROM p""",
    "token_counts": f"WITH {_TF} SELECT * FROM occ",
    "token_ngrams": rf"""WITH l AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'),
        lambda x: x NOT IN ({_SCRIPT['stop']})) AS t FROM documents),
      g AS (SELECT doc_id, unnest(t) AS term FROM l UNION ALL
        SELECT doc_id, t[i] || ' ' || t[i + 1] FROM (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM l))
      SELECT term, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM g GROUP BY term""",
    "topic_tokens": rf"""WITH l AS (SELECT doc_id, list_filter(regexp_extract_all(
        regexp_replace(lower(text), '[^\P{{L}}\x00-\x7F]|[^\P{{N}}\x00-\x7F]', '0', 'g'), '\b[a-zA-Z][a-zA-Z''-]{{2,}}\b'),
        lambda x: x NOT IN ({_SCRIPT['stop']})) AS t FROM documents)
      SELECT doc_id, len(t)::INT AS n, md5(array_to_string(t, ' ')) AS tokens_md5 FROM l""",
    "vocabulary": f"""WITH {_TF}, v AS (SELECT term, sum(n)::BIGINT AS tf, count(*) AS df FROM occ GROUP BY term),
      n AS (SELECT count(*) AS n_docs FROM documents),
      k AS (SELECT term, tf, df, n_docs FROM v, n WHERE df >= 5 AND df <= 0.95::DOUBLE * n_docs ORDER BY tf DESC, term LIMIT 20000)
      SELECT term, (row_number() OVER (ORDER BY term) - 1)::INT AS term_idx, tf, df, n_docs FROM k""",
    "tfidf_long": f"""WITH {_TF}, v AS (SELECT term, sum(n) AS tf, count(*) AS df FROM occ GROUP BY term ORDER BY tf DESC, term LIMIT 20000),
      m AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INT AS term_idx,
        ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1 AS idf FROM v),
      w AS (SELECT doc_id, term_idx, (1 + ln(n)) * idf AS w FROM occ JOIN m USING (term))
      SELECT doc_id, term_idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
    "nb_predictions": f"""WITH {SPLIT}, {_TF},
      v AS (SELECT term, sum(n) AS tf, count(*) AS df FROM occ JOIN split USING (doc_id) WHERE split = 'train'
        GROUP BY term ORDER BY tf DESC, term LIMIT 20000),
      m AS (SELECT term, ln((1 + (SELECT count(*) FROM split WHERE split = 'train'))::DOUBLE / (1 + df)) + 1 AS idf FROM v),
      w0 AS (SELECT doc_id, term, (1 + ln(n)) * idf AS w FROM occ JOIN m USING (term)),
      w AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w0),
      tr AS (SELECT w.*, lang FROM w JOIN split USING (doc_id) WHERE split = 'train'),
      cls AS (SELECT lang, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior FROM split WHERE split = 'train' GROUP BY lang),
      mass AS (SELECT lang, sum(w) AS s FROM tr GROUP BY lang),
      nct AS (SELECT lang, term, sum(w) AS s FROM tr GROUP BY ALL),
      lp AS (SELECT c.lang, m.term, ln(coalesce(nct.s, 0) + 1) - ln(mass.s + (SELECT count(*) FROM m)) AS lp
        FROM cls c CROSS JOIN m JOIN mass ON mass.lang = c.lang LEFT JOIN nct ON nct.lang = c.lang AND nct.term = m.term),
      sc AS (SELECT doc_id, lp.lang, sum(w * lp) AS s FROM w JOIN split USING (doc_id) JOIN lp USING (term)
        WHERE split = 'test' GROUP BY ALL),
      al AS (SELECT t.doc_id, c.lang, c.prior + coalesce(sc.s, 0) AS score FROM split t CROSS JOIN cls c
        LEFT JOIN sc ON sc.doc_id = t.doc_id AND sc.lang = c.lang WHERE t.split = 'test')
      SELECT doc_id, lang AS predicted FROM al QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1""",
    "label_encoding": """SELECT doc_id, (dense_rank() OVER (ORDER BY lang) - 1)::INT AS code, lang AS decoded FROM documents""",
    "content_digest": """WITH r AS (SELECT sha256(doc_id::VARCHAR) AS k, sha256(length(doc_id::VARCHAR) || ':' || doc_id || length(text) || ':' || text) AS h
        FROM documents),
      l2 AS (SELECT substring(k, 1, 2) AS k, sha256(string_agg(h, '' ORDER BY k, h)) AS h FROM r GROUP BY 1),
      l1 AS (SELECT substring(k, 1, 1) AS k, sha256(string_agg(h, '' ORDER BY k, h)) AS h FROM l2 GROUP BY 1)
      SELECT sha256(string_agg(h, '' ORDER BY k, h)) AS digest FROM l1""",
    "csv_roundtrip": "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents",
    "write_and_verify": "SELECT count(*) AS n, sum(length(html))::BIGINT AS characters FROM pages",
}
