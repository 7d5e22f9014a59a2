"""The operators as queries over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weirflow.llm import chat, decontam, hamming, language, lines, neardup, packing, piece_table, prefix_trie, secret_scan, shards, simple8b, toxicity
from weirflow.llm.tokens import default_vocabulary
from weirflow.session import prepare_session


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{folder}/{name}.parquet")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Each row as two events of a log: a message with half its text, a delta with the rest."""
    order = Window.partitionBy("conv_id").orderBy(
        F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")
    )
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    event = lambda step, kind, part: F.struct(
        (F.col("n") * 2 + step).alias("seq"), F.lit(kind).alias("kind"), part.alias("text")
    )
    return (
        conversations.select("conv_id", "turn", "role", "text")
        .withColumn("n", F.row_number().over(order).cast("long"))
        .select(
            "conv_id",
            F.col("n").alias("turn"),
            "role",
            F.explode(
                F.array(
                    event(0, "message", F.substr(text, F.lit(1), half)),
                    event(1, "delta", F.substr(text, half + 1)),
                )
            ).alias("e"),
        )
        .select("conv_id", "e.seq", "turn", "e.kind", "role", "e.text")
    )


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, read back from its rendering."""
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    formatted = chat.format_chats(conversation_events(rows.unionByName(planted)))
    turns = chat.parse(F.col("formatted"))
    masked = chat.masked_text(F.col("formatted"), F.col("loss_spans"))
    newline = F.lit("\n")
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], newline, t["text"], newline)), ""
    )
    return (
        formatted.withColumn("turns", turns)
        .withColumn("masked", masked)
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(whole, 256).alias("turns_sha256"),
            F.char_length("masked").cast("long").alias("loss_chars"),
            F.sha2("masked", 256).alias("loss_sha256"),
            F.char_length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op5_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents dealt to 16 shards whose row counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    documents = read(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    dealt = shards.shard_rows(documents, ["doc_id", "size", "text_crc32", "text_hash"], 16, seed=20)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the lines that are boilerplate of their source."""
    documents = read(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(documents).drop("source")


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their near-duplicate class and number of links."""
    return neardup.jaccard_join(read(spark, folder, "documents"))


def remainder(doc_id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``: decides what is held out of learning."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(by)), F.lit(-1))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored by a model learned from three of four labelled ones."""
    documents = read(spark, folder, "documents").select("doc_id", "text")
    labels = read(spark, folder, "labels").where(remainder("doc_id", 4) != 2)
    model = toxicity.fit(documents, labels)
    return toxicity.scored(documents, model).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "offending"
    )


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' language, by a model learned from two of three documents."""
    documents = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.fit(documents.where(remainder("doc_id", 3) != 1))
    return language.predicted(documents, model).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut and packed into sequences of 2048 tokens."""
    return packing.pack_documents(read(spark, folder, "documents"), default_vocabulary())


TOP_K = 10
VECTOR_SIZE = 64


def op6_hamming_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest codes of each vector whose id is divisible by 50, itself included."""
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    queries = vectors.where(F.pmod("vec_id", F.lit(50)) == 0)
    return hamming.nearest(vectors, queries, "vec_id", "embedding", VECTOR_SIZE, TOP_K)


def op7_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written as Simple-8b files and read back."""
    return simple8b.round_trip(read(spark, folder, "documents"), default_vocabulary(), end_id=2)


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document, whole or edited."""
    return decontam.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' secrets; a source is an owner, a different text a repository."""
    found = secret_scan.scan(read(spark, folder, "documents").select("doc_id", "text", "source"))

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("spans", lambda s: s[field] == value)).cast("long")

    def written(spans: Column) -> Column:
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    return found.select(
        "doc_id",
        *(count("kind", k.name).alias(f"n_{k.name}") for k in secret_scan.BASE),
        F.sha2(written(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each rebuilt on the start of its hundred's first."""
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.trie(*prefix_trie.shared_start_paths(rows))


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents cut and arranged for filling in the middle, and rebuilt from that."""
    written = piece_table.transformed(read(spark, folder, "documents").select("doc_id", "text"))
    return piece_table.restored(written.drop("pieces")).withColumn(
        "restored_sha256", F.sha2("restored", 256)
    ).drop("restored")


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_toxicity": op3_toxicity,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_shards": op5_shards,
    "op6_hamming_search": op6_hamming_search,
    "op7_token_ids": op7_token_ids,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_language": op10_language,
    "op11_secret_scan": op11_secret_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fill_in_middle": op13_fill_in_middle,
}

# SQL for what SQL can say. The digests of op1 are taken of the rows themselves, not of
# a rendering, so they hold whatever the template; formatted_chars follows the template.
_ESCAPES = ("␛", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPED_CHARS = "char_length({c})" + "".join(
    f" + {2 - 1 if s == '␛' else 3 - len(s)} * ((char_length({{c}}) - char_length(replace({{c}}, '{s}', ''))) // {len(s)})"
    for s in _ESCAPES
)


def _found(number: int, pattern: str, group: int, least: int) -> str:
    """SQL for the matches of one pattern: text between matches, then the match."""
    quoted = pattern.replace("'", "''")
    return f"""
        SELECT r, {number} AS kind, value, whole, e - length(whole) AS s, e FROM (
            SELECT r, value, whole, sum(length(gap) + length(whole)) OVER (PARTITION BY r ORDER BY i)::BIGINT AS e FROM (
                SELECT r, unnest(range(1, len(whole) + 1)) AS i, unnest(gaps[1:len(whole)]) AS gap, unnest(whole) AS whole,
                    unnest(value) AS value FROM (
                    SELECT r, string_split_regex(text, '{quoted}') AS gaps, regexp_extract_all(text, '{quoted}') AS whole,
                        regexp_extract_all(text, '{quoted}', {group}) AS value FROM docs)))
        WHERE length(value) >= {least}"""


_WIDER = " ".join(
    f"WHEN regexp_full_match(whole, '{k.pattern}') THEN {len(secret_scan.BASE) + i}"
    for i, k in enumerate(secret_scan.WIDER[:-1])
)
_KINDS = ", ".join(f"'{k.name}'" for k in (*secret_scan.BASE, *secret_scan.WIDER))

ORACLES = {
    "op6_hamming_search": f"""
        WITH codes AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b
            FROM embeddings WHERE len(embedding) = {VECTOR_SIZE}),
        pairs AS (SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id,
                list_sum(list_transform(list_zip(q.b, c.b), lambda z: abs(z[1] - z[2])))::INT AS distance
            FROM codes q, codes c WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank,
                neighbor_id, distance FROM pairs)
        SELECT * FROM ranked WHERE rank <= {TOP_K}""",
    "op1_chat_format": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length('<s></s>') + 1 + {_ESCAPED_CHARS.format(c="role").replace("char_length", "length")}
                + {_ESCAPED_CHARS.format(c="text").replace("char_length", "length")})::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id""",
    "op9_line_dedup": f"""
        WITH pages AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
        totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
        split AS (SELECT DISTINCT source, text, trim(line, ' ' || chr(9) || chr(13)) AS line
            FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
        frequent AS (SELECT s.source, line, pages, count(*) AS n FROM split s JOIN totals t ON s.source IS NOT DISTINCT FROM t.source
            WHERE line <> '' AND pages >= {lines.MIN_PAGES} GROUP BY s.source, line, pages
            HAVING count(*) >= {lines.MIN_LINE_PAGES} AND count(*) > {lines.RATIO} * pages),
        sharing AS (SELECT f.source, f.line, s.text FROM frequent f JOIN split s ON s.source IS NOT DISTINCT FROM f.source AND s.line = f.line),
        worded AS (SELECT text, regexp_extract_all(text, '[^ \t\r\n]+') AS w FROM (SELECT DISTINCT text FROM sharing)),
        digests AS (SELECT text, unnest(list_transform(range(1, greatest(len(w) - {lines.WORDS - 1}, 1) + 1),
            lambda i: md5(array_to_string(w[i:i + {lines.WORDS - 1}], ' ')))) AS d FROM worded),
        sketches AS (SELECT text, j, min(substr(d, 2 * j + 1, 16)) AS s FROM digests CROSS JOIN range({lines.SKETCHES}) t(j) GROUP BY text, j),
        seen AS (SELECT source, line, text, j, s FROM sharing JOIN sketches USING (text)),
        modes AS (SELECT source, line, j, s FROM (SELECT source, line, j, s, count(*) AS n FROM seen GROUP BY ALL)
            QUALIFY row_number() OVER (PARTITION BY source, line, j ORDER BY n DESC, s) = 1),
        agreed AS (SELECT x.source, x.line, x.text FROM seen x JOIN modes m ON m.source IS NOT DISTINCT FROM x.source
            AND m.line = x.line AND m.j = x.j AND m.s = x.s GROUP BY ALL HAVING count(*) >= {lines.AGREE}),
        copies AS (SELECT source, line, count(*) AS c FROM agreed GROUP BY ALL),
        bad AS (SELECT source, line FROM (SELECT f.source, f.line, pages, n - greatest(coalesce(c, 0) - 1, 0) AS n
                FROM frequent f LEFT JOIN copies p ON p.source IS NOT DISTINCT FROM f.source AND p.line = f.line)
            WHERE n >= {lines.MIN_LINE_PAGES} AND n > {lines.RATIO} * pages),
        lists AS (SELECT source, list(line) AS bad FROM bad GROUP BY source),
        kept AS (SELECT doc_id, d.text, string_split(d.text, chr(10)) AS lines,
                CASE WHEN bad IS NULL THEN string_split(d.text, chr(10)) ELSE list_filter(string_split(d.text, chr(10)),
                    lambda x: NOT list_contains(bad, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
            FROM documents d LEFT JOIN lists l ON d.source IS NOT DISTINCT FROM l.source)
        SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
            coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped
        FROM kept""",
    "op11_secret_scan": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
        base AS ({" UNION ALL ".join(_found(i, k.pattern, k.value, k.least) for i, k in enumerate(secret_scan.BASE))}),
        wider AS (SELECT r, CASE {_WIDER} ELSE {len(secret_scan.BASE) + len(secret_scan.WIDER) - 1} END AS kind, value, whole, s, e
            FROM ({_found(0, secret_scan.WIDER_PATTERN, 0, 1)})
            WHERE regexp_matches(whole, '[^A-Za-z0-9+/_=-]') OR (regexp_matches(whole, '[0-9]')
                AND regexp_matches(whole, '[a-z]') AND regexp_matches(whole, '[A-Z]'))),
        held AS (SELECT value, count(*) AS owners, sum(n) AS repositories FROM (
                SELECT value, source, count(DISTINCT text) AS n FROM (SELECT * FROM base UNION ALL SELECT * FROM wider)
                    JOIN docs USING (r) GROUP BY value, source) GROUP BY value),
        spans AS (SELECT r, kind, s, e, CASE WHEN owners > {secret_scan.MAX_OWNERS}
                    OR (owners > 1 AND repositories > {secret_scan.MAX_REPOSITORIES}) THEN 'example'
                WHEN length(value) >= {secret_scan.RANDOM_CHARS} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                    AND len(list_distinct(string_split(value, ''))) >= {secret_scan.RANDOM_DIFFERENT} THEN 'live' ELSE 'plain' END AS verdict
            FROM (SELECT * FROM base UNION ALL SELECT * FROM wider) JOIN held USING (value)),
        kept AS (SELECT *, [{_KINDS}][kind + 1] || ':' || s || ':' || e AS written FROM spans x
            WHERE kind < {len(secret_scan.BASE)} OR (verdict = 'live' AND NOT EXISTS (
                SELECT 1 FROM base b WHERE b.r = x.r AND b.s < x.e AND b.e > x.s)))
        SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
            count(*) FILTER (kind = 2) AS n_hex,
            sha256(coalesce(string_agg(written, ',' ORDER BY s, kind) FILTER (kind < {len(secret_scan.BASE)}), '')) AS base_sha256,
            coalesce(string_agg(written, ',' ORDER BY s, kind), '') AS spans,
            count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example
        FROM docs LEFT JOIN kept USING (r) GROUP BY r, doc_id""",
    "op12_prefix_trie": """
        WITH turns AS (SELECT conv_id AS c, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h,
                length(coalesce(text, '')) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                    coalesce(role, ''), coalesce(text, '')) - 1 AS nth FROM conversations),
        convs AS (SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(c::VARCHAR) + 1),
                    lambda i: [ascii((c::VARCHAR)[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                    lambda r, x: xor(xor(r, x) >> 1, 3988292384 * (xor(r, x) & 1))), 4294967295) % 6 AS h,
                c - c % 100 AS base, count(*) AS n FROM turns GROUP BY c),
        shape AS (SELECT v.c, v.h, v.base, least(v.h, coalesce(b.n, 0)) AS taken,
                least(v.h, coalesce(b.n, 0)) + greatest(v.n - v.h, 0) AS length
            FROM convs v LEFT JOIN convs b ON b.c = v.base),
        steps AS (SELECT s.c, length, taken + nth - s.h + 1 AS depth, t.h, chars FROM shape s JOIN turns t ON t.c = s.c AND nth >= s.h
            UNION ALL SELECT s.c, length, nth + 1, t.h, chars FROM shape s JOIN turns t ON t.c = s.base AND nth < taken),
        paths AS (SELECT c, length, depth, chars, string_agg(h, '') OVER (PARTITION BY c ORDER BY depth) AS k FROM steps
            UNION ALL SELECT c, length, 0, 0, '' FROM shape),
        nodes AS (SELECT k, depth, min(c) AS c, count(*) AS n_convs, any_value(chars) AS chars,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (depth = length), '')) AS ends_sha256
            FROM paths GROUP BY k, depth),
        children AS (SELECT substr(k, 1, 64 * (depth - 1)::BIGINT) AS k, depth - 1 AS depth, count(*) AS n_children FROM nodes
            WHERE depth > 0 GROUP BY ALL),
        facts AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children USING (k, depth)),
        below AS (SELECT substr(k, 1, 64 * d) AS k, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
                sum((n_convs - 1) * chars) AS saved FROM (SELECT *, unnest(range(0, depth::BIGINT + 1)) AS d FROM facts) GROUP BY ALL)
        SELECT f.c AS conv_id, f.depth::BIGINT AS depth, p.c AS parent_conv_id, f.n_convs, f.n_children::BIGINT AS n_children,
            n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, f.ends_sha256
        FROM facts f JOIN below b ON b.k = f.k AND b.depth = f.depth
            LEFT JOIN nodes p ON p.depth = f.depth - 1 AND p.k = substr(f.k, 1, 64 * (f.depth - 1)::BIGINT)""",
    "op13_fill_in_middle": """
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
                sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        drawn AS (SELECT doc_id, text, n, ('0x' || h[1:8])::UBIGINT % (n + 1) AS a, ('0x' || h[9:16])::UBIGINT % (n + 1) AS b,
                CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                    OR ('0x' || h[17:24])::UBIGINT % 100 >= 90 THEN 'plain'
                    WHEN ('0x' || h[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM docs),
        cut AS (SELECT *, least(a, b)::BIGINT AS x, greatest(a, b)::BIGINT AS y FROM drawn),
        parts AS (SELECT *, substr(text, 1, x) AS p, substr(text, x + 1, y - x) AS m, substr(text, y + 1) AS s FROM cut)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
            sha256(text) AS restored_sha256 FROM parts""",
}
