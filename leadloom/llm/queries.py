"""One query per operator, over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    decontaminate,
    exact_dedup,
    kneser_ney,
    language_id,
    license_scan,
    mixing,
    ranked_search,
    simhash,
    substring_dedup,
    token_shards,
    toxicity,
    whitening,
)
from ..session import stage
from .registry import query, table


@query("op4_simhash_near_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, folder, "documents"), shingle_words=3, max_bits=2)
    return found.select("doc_id", simhash.fingerprint_hex("fingerprint").alias("fingerprint"), "component_id")


@query(
    "op5_exact_dedup",
    r"""WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
        FROM d WINDOW same AS (PARTITION BY text_sha256)""",
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def _license_sql() -> str:
    """Every block of every text against every template, without filters."""
    half = license_scan.BLOCK_WORDS // 2
    templates = ", ".join(
        f"('{label}', {license_scan.template_words(text)!r}, ' {license_scan.TELLING[label]} ')" for label, text in license_scan.TEMPLATES.items()
    )
    places = [
        f"[i FOR i IN range(len(w)) IF " + " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(phrase.split())) + "]"
        for phrase in license_scan.BASE_PHRASES
    ]
    labels = list(license_scan.BASE_PHRASES.values())
    bases = ", ".join(f"CASE WHEN len({p}) > 0 THEN '{label}' END" for p, label in zip(("p0", "p1", "p2"), labels))
    return rf"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
                translate(coalesce(text, ''), '{license_scan._UPPER}', '{license_scan._LOWER}'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        places AS (SELECT doc_id, r, len(w) AS n_words, {places[0]} AS p0, {places[1]} AS p1, {places[2]} AS p2 FROM d),
        base AS (SELECT *, list_concat(p0, list_concat(p1, p2)) AS p,
                        list_sort([x FOR x IN [{bases}] IF x IS NOT NULL]) AS b FROM places),
        templates(label, t, told) AS (VALUES {templates}),
        blocks AS (SELECT r, list_distinct(w[k * {half} + 1 : k * {half} + {2 * half}]) AS bw,
                          ' ' || array_to_string(w[k * {half} + 1 : k * {half} + {2 * half}], ' ') || ' ' AS said
                   FROM (SELECT r, w, unnest(range((len(w) + {half} - 1) // {half})) AS k FROM d)),
        scores AS (SELECT r, label, len(list_intersect(t, bw)) AS shared, len(t) AS size FROM blocks, templates WHERE contains(said, told)),
        hits AS (SELECT r, list(DISTINCT label) AS m, max(shared / size) AS best FROM scores
                 WHERE 10 * shared >= {license_scan.CONTAINMENT_TENTHS} * size GROUP BY r)
        SELECT doc_id, n_words, len(p) AS n_base, list_min(p) AS first_word, list_max(p) AS last_word,
               array_to_string(b, ',') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(b, coalesce(m, [])))), ','), '') AS labels,
               CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
        FROM base LEFT JOIN hits USING (r)"""


@query("op9_license_scan", _license_sql())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(table(spark, folder, "documents"))


_PROBE = "</s>[INST] ok [/INST]"

_CHAT_SQL = rf"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '{_PROBE}'), (-7, 1, 'assistant', '{_PROBE}')),
    h AS (SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS plain FROM c),
    f AS (SELECT *, '{chat_format.START}' || {chat_format.escaped_sql('plain')} || chr(10)
                    || {chat_format.escaped_sql('text')} || '{chat_format.END}' || chr(10) AS formatted FROM h)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = '{chat_format.LEARNED_ROLE}'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted)
                           FILTER (role = '{chat_format.LEARNED_ROLE}'), '')) AS loss_sha256,
           sum(length(formatted))::BIGINT AS formatted_chars
    FROM f GROUP BY conv_id"""


@query("op10_chat_formatting", _CHAT_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, number -7, that is made of control strings."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", _PROBE), (-7, 1, "assistant", _PROBE)], given.schema)
    return chat_format.read_back(chat_format.format_turns(given.unionByName(probe)))


_DECONTAMINATION_SQL = rf"""
    WITH words AS (
        SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    split AS (
        SELECT kind, id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM words),
    lengths AS (SELECT DISTINCT least(len(w), {decontaminate.SHINGLE_WORDS}) AS n FROM split WHERE kind = 'b' AND len(w) > 0),
    shingles AS (
        SELECT DISTINCT kind, id, n, unnest([array_to_string(w[i : i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS s
        FROM split, lengths WHERE len(w) >= n AND (kind = 'd' OR n = least(len(w), {decontaminate.SHINGLE_WORDS}))),
    items AS (SELECT id AS item_id, n, s, count(*) OVER (PARTITION BY id) AS size FROM shingles WHERE kind = 'b')
    SELECT d.id AS doc_id, item_id, size AS item_shingles, count(*) AS shared_shingles, count(*) / size AS containment
    FROM shingles d JOIN items ON d.kind = 'd' AND d.n = items.n AND d.s = items.s
    GROUP BY d.id, item_id, size HAVING 10 * count(*) >= {decontaminate.CONTAINMENT_TENTHS} * size"""


@query("op1_benchmark_decontamination", _DECONTAMINATION_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain a benchmark item, with the item."""
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    containment = (F.col("shared_shingles") / F.col("item_shingles")).alias("containment")
    return found.select("doc_id", "item_id", "item_shingles", "shared_shingles", containment)


@query("op3_token_files")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return token_shards.token_table(table(spark, folder, "documents"))


@query("op7_language_id")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_id.identify(docs, language_id.learn(docs))
    held_out = (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score")


@query("op8_source_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """The schedule of all documents, read from the files (or kept rows) that hold their whole texts in mixed order."""
    docs = table(spark, folder, "documents")
    mixed = mixing.mix_sources(docs, mixing.TARGET_WEIGHTS)
    ordered = mixed.repartitionByRange("_position").sortWithinPartitions("_position")
    written = stage(ordered, compression="zstd")
    return written.select(
        "doc_id",
        "source",
        F.col("_block").alias("block"),
        F.col("_slot").alias("slot"),
        F.col("_phase").alias("phase"),
        F.col("_position").alias("position"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@query("op6_substring_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with repeated passages: these, and what is left of the text when they are cut out but where they stand first."""
    rows = substring_dedup.numbered_rows(table(spark, folder, "documents").select("doc_id", "text"))
    cut = substring_dedup.cut_repeats(rows)
    return cut.select(
        "doc_id",
        "passages",
        (F.length("text") - F.length("kept")).cast("long").alias("cut_chars"),
        F.length("kept").cast("long").alias("kept_chars"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op2_toxicity")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


_SEARCH_SQL = rf"""
    WITH split AS (
        SELECT kind, row_number() OVER () AS r, id, regexp_extract_all(
            translate(coalesce(text, ''), '{license_scan._UPPER}', '{license_scan._LOWER}'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark)),
    docs AS (SELECT r, id AS doc_id, len(w) AS n, w FROM split WHERE kind = 'd' AND len(w) > 0),
    whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM docs),
    postings AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM docs) GROUP BY ALL),
    terms AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
              FROM postings, whole GROUP BY term, docs),
    items AS (SELECT DISTINCT r AS i, id AS item_id, unnest(w) AS term FROM split WHERE kind = 'b'),
    scores AS (
        SELECT i, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
        FROM items JOIN terms USING (term) JOIN postings USING (term), whole GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
               FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {ranked_search.TOP}"""


@query("op12_ranked_search", _SEARCH_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_language_model")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return kneser_ney.score(docs, kneser_ney.train(docs))
