"""One query per operator over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalpost.llm import ann, decontam, html, langid, license, lm, mixing, neardup, packing, pii, ranked, toxicity, whitening
from signalpost.llm.common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = langid.fit(docs.filter(~held_out), "lang", "text", "doc_id", vocabulary("piece_bpe_32k.model"))
    found = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model, vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(fold("doc_id", 5) != 0))
    return toxicity.score(docs, model).withColumn("held_out", fold("doc_id", 5) == 0).select(
        "doc_id", "held_out", "score", "predicted", "n_terms", F.concat_ws(",", "terms").alias("terms"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, docs.filter(fold("doc_id", 5) != 1)).withColumn("held_out", fold("doc_id", 5) == 1)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))

    def said(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(said(F.filter("spans", lambda s: s["kind"] != "id")), 256).alias("base_sha256"),
                        said(F.col("spans")).alias("spans"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))[0]


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(ranked.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontaminate": op5_decontaminate,
    "op6_language_model": op6_language_model,
    "op7_license_scan": op7_license_scan,
    "op8_personal_data": op8_personal_data,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_whitening": op11_whitening,
    "op12_ranked_search": op12_ranked_search,
    "op13_source_mixing": op13_source_mixing,
}

# Words of a text: pieces between ASCII white space; a set is the distinct runs of four words, or all words of a shorter text.
ORACLES = {
    "op4_near_duplicates": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
runs AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) <= 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+3], ' ') END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM runs a JOIN runs b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(node, seen) AS (SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id, doc_id <= coalesce(low, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(seen) AS low FROM reach GROUP BY node) USING (doc_id)
""",
    "op5_decontaminate": r"""
WITH words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents),
items AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM benchmark),
cut AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
places AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM cut) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, p.n FROM places p JOIN cut c ON p.s = c.s AND p.n = c.n),
found AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids FROM hits GROUP BY doc_id),
inside AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN found USING (doc_id) LEFT JOIN inside USING (doc_id)
""",
    "op12_ranked_search": r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term, row_id
    FROM (SELECT doc_id, text, row_number() OVER () AS row_id FROM documents)),
tf AS (SELECT row_id, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT row_id, sum(tf)::BIGINT AS n FROM tf GROUP BY row_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM lengths),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, whole),
scores AS (
    SELECT item_id, row_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (row_id), whole GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
""",
    "op13_source_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS o
    FROM documents),
sources AS (
    SELECT source, source_size, [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
    FROM (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source)),
levels AS (
    SELECT *, (sum(source_size) OVER ()::BIGINT - 3 * coalesce(sum(source_size) OVER earlier, 0)::BIGINT)::DOUBLE
              / (sum(w) OVER ()::BIGINT - coalesce(sum(w) OVER earlier, 0)::BIGINT)::DOUBLE AS level
    FROM sources WINDOW earlier AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
    SELECT source, source_size, coalesce(w * first_value(CASE WHEN level * w <= 3 * source_size THEN level END IGNORE NULLS) OVER (
               ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3.0 * source_size)::DOUBLE AS target
    FROM levels),
steps AS (
    SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(floor(target / source_size * 16777216)::BIGINT, 3 * 16777216) END AS step FROM goals),
offsets AS (
    SELECT *, ('0x' || substr(md5('mix:' || CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END || ':' || number), 1, 6))::BIGINT AS u
    FROM steps, (SELECT unnest(range(1, 17)) AS number)),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, o) AS place FROM sized),
tried AS (
    SELECT doc_id, size, source_size, target, number, o.source,
           size * ((place * step + u) // 16777216 - (place * step - step + u) // 16777216) AS taken
    FROM placed p JOIN offsets o ON p.source IS NOT DISTINCT FROM o.source),
best AS (
    SELECT source, number FROM (SELECT source, number, abs(sum(taken) - any_value(target)) AS gap FROM tried GROUP BY source, number)
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY gap, number) = 1)
SELECT doc_id, size, source_size, target, taken
FROM tried t JOIN best b ON t.number = b.number AND t.source IS NOT DISTINCT FROM b.source
""",
}
