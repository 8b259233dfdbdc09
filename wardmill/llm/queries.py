"""Registered queries of the corpus operators, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.llm import (
    chat,
    decontaminate,
    fingerprint,
    line_dedup,
    mix,
    near_dedup,
    pii,
    quality,
    ratio_rules,
    spelling,
    substring_dedup,
    url_filter,
    whitening,
)

RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that each document gives to the mix of sources."""
    plan = mix.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest rule that fits each page's URL, and its verdict."""
    return url_filter.verdicts(table(spark, sf_dir, "pages"), RULES)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the digest of the text that is left, per document."""
    return line_dedup.line_counts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    return fingerprint.compare(table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicates by four-word shingles at a similarity of 0.8."""
    groups = near_dedup.group(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row per overlap."""
    found = decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("digest").withColumnRenamed("id", "doc_id")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of all conversations, read back from raw transcripts of many styles.

    The model is counted on conversations whose crc32(conv_id as text) mod 4 is not 2.
    """
    raw = chat.raw_lines(table(spark, sf_dir, "conversations"))
    model = chat.train(raw.where(~quality.held_out(F.col("conv"))))
    turns = chat.decode(raw, model)
    return turns.select(
        F.col("conv").alias("conv_id"), "turn", "role", F.length(chat.bare(F.col("text"))).cast("long").alias("n_chars"),
        F.sha2(chat.rendered(F.col("role"), F.col("text")), 256).alias("rendered_sha256"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: plain counts and the spans, disguised ones included."""
    return pii.detect(table(spark, sf_dir, "documents")).select(
        "doc_id", *[f"n_{kind}" for kind in pii.KINDS],
        F.sha2("base", 256).alias("base_sha256"), "spans",
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.withColumn("predicted", predicted)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of 20 words that starts earlier too."""
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts of every document, and whether it reads more like trusted ones than not."""
    judged = ratio_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("digest", "n_grams", "score")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in the first four whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its usual form and the root its forms lead to."""
    return spelling.group(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_url_filter": op2_url_filter,
    "op3_line_dedup": op3_line_dedup,
    "op4_fingerprint": op4_fingerprint,
    "op5_near_dedup": op5_near_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_chat": op7_chat,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_whitening": op12_whitening,
    "op13_spelling": op13_spelling,
}

_WORD = r"'[^\x20\x09-\x0D]+'"
_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE = {
    "op1_mix": rf"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, {_WORD})), 0) AS size,
                md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS hash
            FROM documents),
        sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
            FROM sized GROUP BY source),
        weighed AS (
            SELECT *, CASE nth % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE
                ELSE 1.0::DOUBLE END AS weight FROM sources),
        filling AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                - coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    0) * 2.0::DOUBLE)
                / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
                row_number() OVER w AS turn
            FROM weighed WINDOW w AS (ORDER BY source_size / weight, nth)),
        common AS (
            SELECT arg_min(level, turn) AS level FROM filling
            WHERE source_size * 2.0::DOUBLE > level * weight),
        targets AS (
            SELECT f.source, f.source_size,
                CASE WHEN f.source_size * 2.0::DOUBLE <= f.level * f.weight
                    THEN f.source_size * 2.0::DOUBLE ELSE c.level * f.weight END AS target
            FROM filling f LEFT JOIN common c ON true),
        placed AS (
            SELECT s.doc_id, s.size, t.source_size, t.target,
                coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash, s.size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
        cut AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
            FROM placed)
        SELECT doc_id, size, source_size, target,
            CAST(epochs * size + greatest(0, least(size,
                floor(target - epochs * source_size) - start)) AS BIGINT) AS taken
        FROM cut""",
    "op2_url_filter": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0
                THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut),
        fits AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/'
                WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/' END AS rule
            FROM parts)
        SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END
            AS verdict FROM fits""",
    "op3_line_dedup": r"""
        WITH lists AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        occurrences AS (
            SELECT doc_id, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS line FROM lists),
        lines AS (
            SELECT line, length(line) AS size, min((doc_id, pos)) AS first FROM occurrences
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line),
        pairs AS (
            SELECT a.line, CASE WHEN a.size >= b.size THEN a.line ELSE b.line END AS longer,
                CASE WHEN a.size >= b.size THEN b.line ELSE a.line END AS shorter,
                a.size = b.size AS same
            FROM lines a JOIN lines b ON b.size BETWEEN a.size - 1 AND a.size + 1
                AND b.first < a.first
            WHERE a.size >= 20 AND b.size >= 20 AND levenshtein(a.line, b.line) <= 4),
        near AS (
            SELECT DISTINCT line FROM pairs WHERE CASE
                WHEN same THEN len(list_filter(generate_series(1, length(longer)),
                    lambda i: substr(longer, i, 1) <> substr(shorter, i, 1))) <= 1
                ELSE len(list_filter(generate_series(1, length(longer)),
                    lambda i: left(longer, i - 1) || substr(longer, i + 1) = shorter)) > 0 END),
        judged AS (
            SELECT o.doc_id, o.pos, o.line,
                coalesce(l.first < (o.doc_id, o.pos) OR n.line IS NOT NULL, false) AS gone
            FROM occurrences o LEFT JOIN lines l ON o.line = l.line
                LEFT JOIN near n ON o.line = n.line)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op5_near_dedup": rf"""
        WITH RECURSIVE lists AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_A_TO_Z}), {_WORD}),
                []) AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(generate_series(1, len(w) - 3),
                    lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM lists),
        sizes AS (
            SELECT l.doc_id, count(s.shingle) AS n FROM lists l LEFT JOIN shingles s
                ON l.doc_id = s.doc_id GROUP BY l.doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
            WHERE 100 * c >= 80 * (p.n + q.n - c)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM lists
            UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON r.other = l.x),
        least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
        SELECT l.doc_id, s.n AS n_shingles, l.component_id, l.doc_id = l.component_id AS kept
        FROM least l JOIN sizes s ON l.doc_id = s.doc_id""",
    "op10_substring_dedup": rf"""
        WITH lists AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, {_WORD}), []) AS w FROM documents),
        windows AS (
            SELECT doc_id, unnest(generate_series(1, len(w) - 19)) AS pos,
                unnest(list_transform(generate_series(1, len(w) - 19),
                    lambda i: md5(array_to_string(w[i:i + 19], ' ')))) AS hash
            FROM lists WHERE len(w) >= 20),
        later AS (
            SELECT doc_id, pos FROM (
                SELECT doc_id, pos,
                    row_number() OVER (PARTITION BY hash ORDER BY doc_id, pos) AS nth FROM windows)
            WHERE nth > 1),
        words AS (
            SELECT doc_id, unnest(generate_series(1, len(w))) AS pos, unnest(w) AS word FROM lists),
        marked AS (
            SELECT w.doc_id, w.pos, w.word, coalesce(max(l.pos) OVER (PARTITION BY w.doc_id
                ORDER BY w.pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
            FROM words w LEFT JOIN later l ON w.doc_id = l.doc_id AND w.pos = l.pos),
        kept AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_removed,
                string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS text
            FROM marked GROUP BY doc_id)
        SELECT l.doc_id, len(l.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
            sha256(coalesce(k.text, '')) AS kept_sha256
        FROM lists l LEFT JOIN kept k ON l.doc_id = k.doc_id""",
    "op11_quality_rules": rf"""
        WITH lists AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                coalesce(regexp_extract_all(text, {_WORD}), []) AS w FROM documents),
        trusted AS (
            SELECT doc_id FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL
            GROUP BY doc_id HAVING min(quality) = 1
            ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 20000),
        words AS (
            SELECT r, doc_id, unnest(generate_series(1, len(w))) AS pos, unnest(w) AS word FROM lists),
        ids AS (
            SELECT word, CAST('0x' || left(md5(word), 8) AS BIGINT) AS id
            FROM (SELECT DISTINCT word FROM words)),
        numbered AS (
            SELECT r, doc_id, id, lag(id) OVER (PARTITION BY r ORDER BY pos) AS before
            FROM words JOIN ids USING (word)),
        grams AS (
            SELECT r, doc_id, id % 65521 AS bucket FROM numbered
            UNION ALL SELECT r, doc_id, (before * 1000003 + id) % 65521 FROM numbered
            WHERE before IS NOT NULL),
        counted AS (
            SELECT b AS bucket, count(g.bucket) + 1 AS n,
                count(g.bucket) FILTER (g.doc_id IN (SELECT doc_id FROM trusted)) + 1 AS good
            FROM generate_series(0, 65520) AS s(b) LEFT JOIN grams g ON g.bucket = b GROUP BY b),
        weights AS (
            SELECT bucket, CASE WHEN sum(good) OVER () = 65521 THEN 0 ELSE CAST(floor(65536 * ln(
                (good / sum(good) OVER ()) / (n / sum(n) OVER ())) + 0.5) AS BIGINT) END AS weight
            FROM counted),
        scores AS (
            SELECT r, count(*) AS n_grams, sum(weight) AS weight
            FROM grams JOIN weights USING (bucket) GROUP BY r),
        windows AS (
            SELECT r, pos, count(*) OVER (PARTITION BY r, hash) AS times FROM (
                SELECT r, unnest(generate_series(1, len(w) - 7)) AS pos, unnest(list_transform(
                    generate_series(1, len(w) - 7),
                    lambda i: md5(array_to_string(w[i:i + 7], ' ')))) AS hash
                FROM lists WHERE len(w) >= 8)),
        covered AS (
            SELECT words.r, words.pos, max(CASE WHEN times > 1 THEN windows.pos END) OVER (
                PARTITION BY words.r ORDER BY words.pos ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)
                IS NOT NULL AS yes
            FROM words LEFT JOIN windows ON words.r = windows.r AND words.pos = windows.pos),
        repeated AS (SELECT r, count(*) FILTER (yes) AS n FROM covered GROUP BY r),
        lines AS (
            SELECT r, count(*) - count(DISTINCT line) AS n
            FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM lists)
            WHERE regexp_matches(line, {_WORD}) GROUP BY r),
        judged AS (
            SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words,
                CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
                s.weight >= -16384 * s.n_grams AS fits
            FROM lists l LEFT JOIN scores s USING (r) LEFT JOIN repeated USING (r)
                LEFT JOIN lines USING (r)),
        base AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM judged)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND coalesce(fits, true) AS kept FROM base""",
    "op13_spelling": rf"""
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1
                THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY i) AS entry
            FROM (SELECT unnest(generate_series(0::BIGINT, 255::BIGINT)) AS i)),
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, {_A_TO_Z}), '[A-Za-zÀ-ÿ]+')) AS run
            FROM documents),
        once AS (
            SELECT run, count(*) AS k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)) AS h
            FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
        summed AS (
            SELECT run, k, xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || list_transform(
                generate_series(1, CAST(len(h) / 2 AS BIGINT)),
                lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT)),
                lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1]))) AS h
            FROM once, crc),
        marked AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, k FROM summed),
        words AS (
            SELECT word, CAST(sum(k) AS BIGINT) AS n FROM marked
            WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
        variants AS (
            SELECT word, n, 0 AS pos, word AS variant FROM words
            UNION ALL SELECT word, n, i, left(word, i - 1) || substr(word, i + 1)
            FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)),
        pairs AS (
            SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n
            FROM variants a JOIN variants b ON a.variant = b.variant AND a.word <> b.word
            WHERE a.pos = 0 OR b.pos = 0 OR a.pos = b.pos),
        best AS (
            SELECT word, count(*) AS n_near,
                min((-near_n, encode(near), near)) FILTER (near_n >= 5 * n) AS b
            FROM pairs GROUP BY word),
        formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, b[3] AS form, -b[1] AS form_n
            FROM words w LEFT JOIN best ON w.word = best.word),
        chain AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word
            WHERE f.form IS NOT NULL),
        roots AS (
            SELECT c.word, c.root FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NULL)
        SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN roots r ON f.word = r.word""",
}
