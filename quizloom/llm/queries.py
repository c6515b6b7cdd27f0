"""One query per operator, over whole tables, and its DuckDB equivalent where SQL has one."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.llm import (
    exact_dedup,
    fim,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    resample,
    secrets,
    spotsigs,
    toxicity,
    warc,
)

# Stands for a key that a user would read from a secret store.
PII_KEY = "key of the registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(documents).select(
        "doc_id", "n_lines", "n_dropped", "kept_sha256"
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(documents, PII_KEY)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train_toxicity(documents, labels)
    return toxicity.score_toxicity(documents, model).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    index = exact_dedup.build_index(documents)
    return exact_dedup.mark_copies(documents, index).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train_quality(documents, labels)
    return quality.judge_quality(documents, model).drop("text")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(documents).select("doc_id", "domain", "lang", "source", "epoch")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(documents)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan_secrets(documents).drop("text")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(documents).select(
        "doc_id", "class_id", "n_links", "n_copies", "kept"
    )


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    target = _table(spark, sf_dir, "benchmark").select("text")
    return resample.resample(documents, target).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spotsigs.compare_neighbours(documents)


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    output, form = F.col("output"), F.col("form")
    return fim.fill_in_middle(documents).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fim.restored(output, form), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii": op2_pii,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality": op6_quality,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_secrets": op9_secrets,
    "op10_ngram_join": op10_ngram_join,
    "op11_resample": op11_resample,
    "op12_spotsigs": op12_spotsigs,
    "op13_fim": op13_fim,
}


def _sql_weights(level: str) -> str:
    cases = "".join(f" WHEN {level} = '{k}' THEN {w}" for k, w in mixing.WEIGHTS[level].items())
    return f"CASE{cases} ELSE {mixing.OTHER} END" if cases else str(mixing.OTHER)


def _sql_budgets() -> str:
    """Budgets of every level of the tree, as CTEs ``level0``, ``level1``, ..."""
    parts = []
    for depth, level in enumerate(mixing.LEVELS):
        path, family = mixing.LEVELS[: depth + 1], mixing.LEVELS[:depth]
        key = ", ".join(path)
        inside = f"PARTITION BY {', '.join(family)}" if family else ""
        if family:
            same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM u.{c}" for c in family)
            source = f"nodes{depth} n JOIN level{depth - 1} u ON {same}"
            given = "u.budget"
        else:
            source, given = f"nodes{depth} n", "least((SELECT budget FROM total), sum(n.cap) OVER ())"
        columns = ", ".join(f"n.{c}" for c in path)
        parts.append(f"""
        nodes{depth} AS (
            SELECT {key}, sum(cap) AS cap, {_sql_weights(level)} AS w FROM leaves GROUP BY {key}
        ), family{depth} AS (
            SELECT {columns}, n.cap, n.w, {given} AS given FROM {source}
        ), ranked{depth} AS (
            SELECT *,
                   given - coalesce(sum(cap) OVER (
                       {inside} ORDER BY cap / w, {level}
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
                   sum(w) OVER ({inside} ORDER BY cap / w, {level}
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
            FROM family{depth}
        ), filled{depth} AS (
            SELECT *, remaining > 0 AND cap * open_w <= w * remaining AS is_full
            FROM ranked{depth}
        ), level{depth} AS (
            SELECT {key}, CASE WHEN is_full THEN cap ELSE
                   w * (given - coalesce(sum(cap) FILTER (is_full) OVER ({inside}), 0))
                   // sum(w) FILTER (NOT is_full) OVER ({inside}) END AS budget
            FROM filled{depth}
        )""")
    return ",".join(parts)


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op1_line_dedup": f"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ), keyed AS (
            SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS key
            FROM split
        ), owners AS (
            SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ), marked AS (
            SELECT k.*, o.owner IS NOT NULL AND o.owner <> k.doc_id AS gone
            FROM keyed k LEFT JOIN owners o USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op5_exact_dedup": r"""
        WITH normal AS (
            SELECT doc_id,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM normal WINDOW same AS (PARTITION BY norm)""",
    "op3_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM payloads
        ), groups AS (
            SELECT *, [('0x' || substr(hex, 5 * i + 1, 5))::INTEGER FOR i IN range(8)] AS fives
            FROM firsts
        ), digits AS (
            SELECT *, flatten([[(v >> 15) & 31, (v >> 10) & 31, (v >> 5) & 31, v & 31]
                               FOR v IN fives]) AS bits
            FROM groups
        )
        SELECT page_id, octet_length(encode(body)) AS payload_bytes,
               list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', b + 1, 1) FOR b IN bits],
                              'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM digits""",
    "op7_mixing": rf"""
        WITH docs AS (
            SELECT doc_id, lang, source,
                   CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) <> '' THEN 'domain' ||
                        (regexp_extract(source, '([0-9]{{1,9}})$', 1)::INTEGER % {mixing.DOMAINS})
                   END AS domain,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
                   md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS row
            FROM documents
        ), leaves AS (
            SELECT domain, lang, source, sum(tokens) AS tokens,
                   sum(tokens) * {mixing.MAX_EPOCHS} AS cap
            FROM docs GROUP BY ALL
        ), total AS (SELECT floor(sum(tokens) * 0.8)::BIGINT AS budget FROM docs),
        {_sql_budgets()}, plan AS (
            SELECT l.domain, l.lang, l.source,
                   CASE WHEN l.tokens > 0 THEN b.budget // l.tokens ELSE 0 END AS whole,
                   CASE WHEN l.tokens > 0 THEN b.budget % l.tokens ELSE 0 END AS part
            FROM leaves l JOIN level2 b ON l.domain IS NOT DISTINCT FROM b.domain
                AND l.lang IS NOT DISTINCT FROM b.lang AND l.source IS NOT DISTINCT FROM b.source
        ), reading AS (
            SELECT d.*, p.whole, p.part, sum(d.tokens) OVER (
                       PARTITION BY d.domain, d.lang, d.source
                       ORDER BY md5('{mixing.SEED}:' || p.whole || ':' || d.row)
                       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
            FROM docs d JOIN plan p ON d.domain IS NOT DISTINCT FROM p.domain
                AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source
        )
        SELECT doc_id, domain, lang, source, unnest(range(
                   (whole + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END)::BIGINT
               )) AS epoch
        FROM reading""",
    "op11_resample": rf"""
        WITH crc_table AS (
            SELECT list(crc ORDER BY i) AS entries FROM (
                SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
                       ) AS crc
                FROM range(256) t(i)
            )
        ), texts AS (
            SELECT true AS own, doc_id, text, coalesce(doc_id::VARCHAR, '') AS id,
                   row_number() OVER () AS row
            FROM documents
            UNION ALL SELECT false, NULL, text, '', 0 FROM benchmark
        ), words AS (
            SELECT own, row, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '{resample.WORD_PATTERN}')) AS word
            FROM texts
        ), bytes AS (
            SELECT word, hex(encode(word)) AS digits FROM (SELECT DISTINCT word FROM words)
        ), coded AS (
            SELECT word, xor(list_reduce(
                       [4294967295::UBIGINT] || [('0x' || substr(digits, 2 * i + 1, 2))::UBIGINT
                                                 FOR i IN range(length(digits) // 2)],
                       lambda c, b: xor(entries[(xor(c, b) & 255)::BIGINT + 1], c >> 8)
                   ), 4294967295) % {resample.BUCKETS} AS bucket
            FROM bytes, crc_table
        ), used AS (SELECT own, row, bucket FROM words JOIN coded USING (word)),
        sums AS (
            SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t
            FROM used GROUP BY bucket
        ), totals AS (SELECT sum(s)::DOUBLE AS all_s, sum(t)::DOUBLE AS all_t FROM sums),
        gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + {resample.BUCKETS}))
                       / ((s + 1)::DOUBLE * (all_t + {resample.BUCKETS}))))::BIGINT AS gain
            FROM sums, totals
        ), weights AS (
            SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
            FROM used JOIN gains USING (bucket) WHERE own GROUP BY row
        ), scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('{resample.SEED}:' || id), 1, 8))::BIGINT + 0.5::DOUBLE)
                       / 4294967296)))::BIGINT AS score
            FROM texts LEFT JOIN weights USING (row) WHERE own
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= {resample.MIN_WORDS}
                                         ORDER BY score DESC, doc_id) AS place,
                   count(*) OVER (PARTITION BY n_features >= {resample.MIN_WORDS})
                       * {resample.PERCENT} // 100 AS draws
            FROM scored
        )
        SELECT doc_id, n_features, weight, score,
               CASE WHEN n_features >= {resample.MIN_WORDS} AND place <= draws THEN place END AS rank
        FROM ranked""",
    "op13_fim": rf"""
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''),
                       '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens,
                   sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digits
            FROM documents
        ), hashed AS (
            SELECT *, len(tokens) AS n, ('0x' || substr(digits, 1, 8))::BIGINT AS h1,
                   ('0x' || substr(digits, 9, 8))::BIGINT AS h2,
                   ('0x' || substr(digits, 17, 8))::BIGINT AS h3,
                   ('0x' || substr(digits, 25, 8))::BIGINT AS h4
            FROM cut
        ), formed AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR h3 % 100 >= {fim.FIM_PERCENT} THEN 'plain'
                        WHEN h4 % 100 < {fim.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
            FROM hashed
        ), parts AS (
            SELECT *, array_to_string(tokens[:low], '') AS prefix,
                   array_to_string(tokens[low + 1:high], '') AS middle,
                   array_to_string(tokens[high + 1:], '') AS suffix
            FROM formed
        )
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                          WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                          ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts""",
}
