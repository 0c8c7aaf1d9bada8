"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, bagminhash, byte_bpe, decontaminate, hard_negatives, html_main, langmix, license_join, merkle, spm_sampling, token_files, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def learned_languages(docs: DataFrame) -> langmix.Model:
    """The model of the documents whose remainder modulo 4 is not 2."""
    return langmix.train(docs.filter(remainder("doc_id", 4) != 2))


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by mixture inference; a null id is not held out."""
    docs = table(spark, sf_dir, "documents")
    found = langmix.identify(docs, learned_languages(docs))
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score",
                        F.size("langs").cast("long").alias("n_langs"))


#: Distinct segmentations drawn per document.
SAMPLES = 2


def piece_model() -> str:
    """The public SentencePiece model's place, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_spm_gumbel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with a checksum of the ids."""
    found = spm_sampling.encode_samples(table(spark, sf_dir, "documents"), piece_model(), SAMPLES)
    return found.select("doc_id", F.col("sample").cast("long").alias("sample"), "n_pieces", F.crc32("ids").alias("ids_crc32"),
                        "log_prob", "perturbed", "log_inclusion", "round_trip")


def op2_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and unigram log10 probabilities of every document; a null id is neither held out nor learned from."""
    import public_tokenizers

    found = attention_lm.score(table(spark, sf_dir, "documents"), remainder("doc_id", 10) != 0, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return found.select("doc_id", F.coalesce(remainder("doc_id", 10) == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_ids")


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    found = merkle.edited_by_next(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("root").alias("fingerprint"), F.col("edited_root").alias("edited_fingerprint"),
                        merkle.likeness("", "edited_").alias("near_edited"), merkle.likeness("", "next_").alias("near_next"),
                        F.size("paragraphs").cast("long").alias("n_paragraphs"), F.size("sections").cast("long").alias("n_sections"),
                        merkle.first_edit("", "edited_").alias("first_edit"))


def op4_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_main.extract(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum of ids, from the written files."""
    import public_tokenizers

    found = token_files.file_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template matches of every document."""
    return license_join.scan(table(spark, sf_dir, "documents"))


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and near-duplicate group of every document."""
    return bagminhash.duplicate_groups(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    found = warc.archive_round_trip(pages)
    return found.select(F.expr(f"try_cast(page_id as {kind.simpleString()})").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                        "record_type", F.expr(f"try_cast(refers_to as {kind.simpleString()})").alias("refers_to"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of every document's ids and of the bytes they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector; a deviation beyond 64 bits is null."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES = {
    "op1_spm_gumbel": op1_spm_gumbel,
    "op2_attention_lm": op2_attention_lm,
    "op3_merkle": op3_merkle,
    "op4_html_main": op4_html_main,
    "op5_token_files": op5_token_files,
    "op6_license_scan": op6_license_scan,
    "op7_bagminhash": op7_bagminhash,
    "op8_warc": op8_warc,
    "op9_decontaminate": op9_decontaminate,
    "op10_language_mixture": op10_language_mixture,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

#: Phrases as the Spark regular expression cuts them; a hash of a phrase stands for the phrase itself.
_PHRASES = "flatten(list_transform({p}, lambda q: CASE WHEN regexp_matches(q, '\\S') THEN regexp_extract_all(q, '\\s*(?:\\S+(?:\\s+|$)){{1,8}}') ELSE [q] END))"
_ROOT = "sha256(array_to_string(list_transform(string_split(regexp_replace(array_to_string(list_transform({p}, lambda q: sha256(q)), ' '), '0 ', '0|', 'g'), '|'), lambda q: sha256(q)), ' '))"

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _license_sql() -> str:
    """Every block against every template, and every phrase at every word."""
    phrases = ", ".join(f"({p.split()!r}, '{label}')" for p, label in license_join.PHRASES.items())
    templates = ", ".join(f"({sorted(set(license_join.words_of(t)))!r}, '{label}', {license_join.needed(len(set(license_join.words_of(t))), license_join.THRESHOLD)})" for label, t in license_join.TEMPLATES)
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOW} AS low FROM documents),
        w AS (SELECT r, doc_id, regexp_extract_all(low, '{_WORDS}') AS w FROM d),
        phrases(p, label) AS (VALUES {phrases}),
        places AS (SELECT r, label, i - 1 AS i FROM (SELECT r, w, p, label, unnest(range(1, len(w) - len(p) + 2)) AS i FROM w, phrases WHERE len(w) >= len(p)) WHERE w[i:i + len(p) - 1] = p),
        base AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS z, list(DISTINCT label) AS l FROM places GROUP BY r),
        blocks AS (SELECT r, list_distinct(regexp_extract_all(b, '{_WORDS}')) AS b FROM (SELECT r, unnest(string_split(regexp_replace(translate(low, chr(1), chr(2)), '\\n[ \\t-\\r]*\\n|[.!?;]([ \\t-\\r])', chr(1) || '\\1', 'g'), chr(1))) AS b FROM d)),
        templates(t, label, k) AS (VALUES {templates}),
        hits AS (SELECT r, label, len(list_intersect(b, t))::DOUBLE / len(t) AS s FROM blocks, templates WHERE len(b) >= k AND len(list_intersect(b, t)) >= k),
        more AS (SELECT r, list(DISTINCT label) AS l, max(s) AS s FROM hits GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
               coalesce(array_to_string(list_sort(base.l), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(coalesce(base.l, []) || coalesce(more.l, []))), ','), '') AS labels, coalesce(more.s, 0.0) AS score
        FROM w LEFT JOIN base USING (r) LEFT JOIN more USING (r)"""


ORACLE: dict[str, str] = {
    "op6_license_scan": _license_sql(),
    "op3_merkle": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        n AS (SELECT doc_id, t, length(t) AS c, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS nt FROM d),
        e AS (SELECT *, substring(t, 1, c - c // 2) || substring(nt, 1, c // 2) AS et FROM n),
        s AS (SELECT *, string_split(t, chr(10)) AS p, string_split(et, chr(10)) AS ep, string_split(nt, chr(10)) AS np FROM e),
        f AS (SELECT *, {_ROOT.format(p="p")} AS r, {_ROOT.format(p="ep")} AS er, {_PHRASES.format(p="p")} AS a, {_PHRASES.format(p="ep")} AS ea, {_PHRASES.format(p="np")} AS na FROM s)
        SELECT doc_id, c::BIGINT AS n_chars, sha256(et) AS edited_sha256, r AS fingerprint, er AS edited_fingerprint,
               CASE WHEN t = et THEN 1.0 ELSE len(list_intersect(a, ea))::DOUBLE / len(list_distinct(a || ea)) END AS near_edited,
               CASE WHEN t = nt THEN 1.0 ELSE len(list_intersect(a, na))::DOUBLE / len(list_distinct(a || na)) END AS near_next,
               len(p)::BIGINT AS n_paragraphs,
               len(string_split(regexp_replace(array_to_string(list_transform(p, lambda q: sha256(q)), ' '), '0 ', '0|', 'g'), '|'))::BIGINT AS n_sections,
               CASE WHEN t <> et THEN list_position(list_transform(range(1, greatest(len(p), len(ep)) + 1), lambda i: p[i] IS NOT DISTINCT FROM ep[i]), false)::BIGINT - 1 END AS first_edit
        FROM f""",
    "op12_hard_negatives": """
        WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda c: floor(c::DOUBLE * 256)) AS x
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_inner_product(a.x, e.x)::BIGINT AS score
              FROM e AS a, e WHERE a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5""",
    "op8_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        q AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM p),
        f AS (SELECT d, min(page_id) AS first FROM q WHERE n >= 100 GROUP BY d)
        SELECT q.page_id, q.n::BIGINT AS payload_bytes, q.d AS payload_digest,
               CASE WHEN f.first IS NULL OR q.page_id IS NOT DISTINCT FROM f.first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN f.first IS NULL OR q.page_id IS NOT DISTINCT FROM f.first THEN NULL ELSE f.first END AS refers_to
        FROM q LEFT JOIN f ON q.d = f.d""",
    "op9_decontaminate": """
        WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bx AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0),
        bn AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM bx),
        sizes AS (SELECT DISTINCT n FROM bn),
        dx AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n),
        hits AS (SELECT r, i, dx.n, item_id FROM dx JOIN bn ON bn.n = dx.n AND bn.g = array_to_string(w[i:i + dx.n - 1], ' ')),
        words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
        items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s FROM hits GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN words USING (r) LEFT JOIN items USING (r)""",
}
