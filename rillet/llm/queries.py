"""The registered queries of the training-data operators and their DuckDB SQL.

Where SQL can't express a query (hashes or models that DuckDB lacks, approximate search),
tests hold it against a brute-force version instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import ann, bpe, chat, mixing, order, packing, quality, repair, search, simhash, substring, toxicity, urls

#: The rules of op9 and the conversation that op2 adds.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
CONTROL_CHAT = "(-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> dict[str, str]:
    """The public rank file and its pattern."""
    import public_tokenizers

    return {"ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components at 3 differing bits."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what reading the result back gives."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(f"SELECT * FROM VALUES {CONTROL_CHAT} AS t(conv_id, turn, role, text)"))
    done = chat.format_chats(turns).withColumn("turns", chat.parse_chat(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    line = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(line, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid", F.col("broken_at").cast("long").alias("broken_at"))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents' byte sequences in permuted order, read back slot by slot."""
    shards = order.materialise(table(spark, sf_dir, "documents").select("doc_id", "text"), length=1024, key=42)
    return order.read_back(spark, shards).select("slot", "shard", "byte_offset", F.col("id").alias("doc_id"), "seq", "n_tokens", "tokens_sha256")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 35-word windows that also start elsewhere."""
    cut = substring.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of all documents, the base rules and the verdicts of hosts."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry_text=False)
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, carry_text=False)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the public ranks, and decoded again."""
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), **tokenizer(), carry_text=False, ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, by weights 1, 2, 3 of the sources."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), weights=(1, 2, 3), limit=3.0)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and verdict of every page's url."""
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where("vec_id % 20 = 0"), k=20)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the faults that op11 plants by a checksum of id and turn: the row is
    ``gone``, its text empty or without ends of sentences, the row twice, or its role the user's."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    fault = F.col("fault")
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault")).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(fault == 0))).alias("gone"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    fixed = repair.repair(damaged(table(spark, sf_dir, "conversations")), gone="gone")
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    return fixed.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(lines, 256).alias("repaired_sha256"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 1,024; ids are reduced to their checksum before they move."""
    import public_tokenizers

    pieces = packing.token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
                                  capacity=1024, end=2)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=1024)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


QUERIES = {f.__name__: f for f in (op1_simhash, op2_chat_format, op3_training_order, op4_substring_dedup, op5_quality_rules,
                                   op6_toxicity, op7_byte_bpe, op8_mix_sources, op9_url_filter, op10_nearest, op11_conversation_repair,
                                   op12_best_fit_packing, op13_ranked_search)}

#: Fixed values of SQL: the words of a text.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE = {
    "op2_chat_format": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
        coded AS (
            SELECT *, length(text) + 4 * (length(text) - length(replace(text, '&', ''))) + 5 * (length(text) - length(replace(text, '[', '')))
                + 5 * (length(text) - length(replace(text, ']', ''))) + 3 * (length(text) - length(replace(text, '<', '')))
                + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
                  ELSE 14 + length(replace(replace(replace(replace(role, '&', '&amp;'), '[', '&lsqb;'), '<', '&lt;'), ']', '&rsqb;')) END AS chars,
                row_number() OVER w - 1 AS i, lag(role) OVER w AS before FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
        walked AS (
            SELECT *, CASE WHEN i = 0 THEN role IN ('system', 'user') ELSE (before || '>' || role) IN ('system>user', 'user>assistant', 'assistant>user') END AS allowed
            FROM coded)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars, bool_and(allowed) AND arg_max(role, i) IN ('assistant', 'user') AS valid,
            min(i) FILTER (NOT allowed) AS broken_at
        FROM walked GROUP BY conv_id""",
    "op4_substring_dedup": f"""
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
        windows AS (SELECT r, i, array_to_string(words[i:i + 34], ' ') AS w
                    FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS i FROM texts WHERE len(words) >= 35)),
        repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
        gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows SEMI JOIN repeated USING (w)),
        kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS line, count(*) AS n
                 FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM texts) ANTI JOIN gone USING (r, p) GROUP BY r)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(coalesce(line, '')) AS kept_sha256
        FROM texts LEFT JOIN kept USING (r)""",
    "op5_quality_rules": f"""
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
        windows AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
                    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM texts WHERE len(words) >= 8)),
        marked AS (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows),
        repeats AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM marked WHERE n > 1) GROUP BY r),
        lines AS (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
                  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r, line),
        dups AS (SELECT r, sum(n - 1) AS n_dup_lines FROM lines GROUP BY r),
        measured AS (
            SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
            FROM texts LEFT JOIN repeats USING (r) LEFT JOIN dups USING (r)),
        ruled AS (SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2, 10 * n_symbols > word_chars AS f3 FROM measured),
        hosts AS (SELECT source, count(*) AS n, sum(f1::INT) AS k1, sum(f2::INT) AS k2, sum(f3::INT) AS k3 FROM ruled WHERE source IS NOT NULL GROUP BY source),
        totals AS (
            SELECT r, CAST(count(*) AS DOUBLE) AS i, CAST(sum(n) AS DOUBLE) AS n, sum(n * CAST(n AS DOUBLE)) AS nn, CAST(sum(k) AS DOUBLE) AS k, sum(k * CAST(k AS DOUBLE) / n) AS kk
            FROM (SELECT n, unnest([1, 2, 3]) AS r, unnest([k1, k2, k3]) AS k FROM hosts) GROUP BY r),
        corr AS (
            SELECT r, n, k / n AS m, CASE WHEN k > 0 AND k < n AND n - nn / n - (i - 1) > 0
                THEN ((kk - k * k / n) / (k / n * (1 - k / n)) - (i - 1)) / (n - nn / n - (i - 1)) ELSE 0 END AS c FROM totals),
        strengths AS (SELECT r, m, CASE WHEN c > 0 THEN greatest(1 / c - 1, 2) ELSE n END AS s FROM corr),
        priors AS (SELECT any_value(m) FILTER (r = 1) AS m1, any_value(m) FILTER (r = 2) AS m2, any_value(m) FILTER (r = 3) AS m3,
            any_value(s) FILTER (r = 1) AS s1, any_value(s) FILTER (r = 2) AS s2, any_value(s) FILTER (r = 3) AS s3 FROM strengths),
        verdicts AS (SELECT source, greatest((k1 + m1 * s1) / (n + s1), (k2 + m2 * s2) / (n + s2), (k3 + m3 * s3) / (n + s3)) > 0.5 AS rejected
                     FROM hosts, priors)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
            NOT (f1 OR f2) AND NOT coalesce(rejected, false) AS kept
        FROM ruled LEFT JOIN verdicts USING (source)""",
    "op8_mix_sources": f"""
        WITH sized AS (
            SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
        walked AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY
                length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)), CAST('0x' || digest[1:2] AS INT), size, doc_id) AS place FROM sized),
        sources AS (
            SELECT source, CAST(sum(size) AS DOUBLE) AS s, [1.0, 2.0, 3.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
            FROM sized GROUP BY source),
        shares AS (
            SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM sources),
        open AS (SELECT max(share) AS share FROM shares WHERE share * w <= 3 * s),
        targets AS (
            SELECT source, s, least(open.share * w, 3 * s) AS target,
                (CAST('0x' || md5('42:' || coalesce(source, chr(0)))[1:5] AS INT) + 0.5::DOUBLE) / 1048576 AS u
            FROM shares, open)
        SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
            CASE WHEN s > 0 THEN CAST(least(floor(target / s * place + u) - floor(target / s * (place - 1) + u), 3) AS BIGINT) * size ELSE 0 END AS taken
        FROM walked JOIN targets ON walked.source IS NOT DISTINCT FROM targets.source""",
    "op9_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
        parsed AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        met AS (
            SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM parsed JOIN rules
            ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parsed LEFT JOIN met USING (page_id)""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        bits AS (SELECT range AS b, list_reduce([CAST(range AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS code FROM range(256)),
        codes AS (SELECT list(code ORDER BY b) AS code FROM bits),
        summed AS (
            SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::BIGINT, [CAST(ascii(x) AS BIGINT) FOR x IN string_split(key, '')]),
                lambda c, x: xor(c >> 8, code[1 + (xor(c, x) & 255)])), 4294967295) % 20 AS fault FROM keyed, codes),
        damaged AS (
            SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
                CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM summed, range(2) WHERE fault <> 0 AND (range = 0 OR fault = 3)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
        ordered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
                lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
        judged AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                before IS NOT NULL AND before || role[1] NOT IN ('su', 'ua', 'au') AS clash FROM ordered),
        counted AS (
            SELECT conv_id, count(*) AS n, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (clash) AS illegal FROM judged GROUP BY conv_id),
        moves(q, a, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        inserts(q, price, audit, made, q2) AS (VALUES (0, 0, '', []::VARCHAR[], 0), (1, 0, '', [], 1), (2, 0, '', [], 2), (3, 0, '', [], 3),
            (0, 5, 'I', ['user:'], 2), (1, 5, 'I', ['user:'], 2), (2, 5, 'I', ['assistant:'], 3), (3, 5, 'I', ['user:'], 2),
            (0, 10, 'II', ['user:', 'assistant:'], 3), (1, 10, 'II', ['user:', 'assistant:'], 3)),
        edits AS (
            SELECT conv_id, i, q, 2 AS price, 'D' AS edit, []::VARCHAR[] AS made, q AS q2 FROM judged, range(4) AS r(q)
            UNION ALL
            SELECT conv_id, i, q, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, 'K', [role || ':' || text], q2
            FROM judged JOIN moves ON role[1] = a WHERE fault IN ('', 'truncated')
            UNION ALL
            SELECT conv_id, i, q, CASE WHEN fault = 'truncated' THEN 6 ELSE 1 END, 'R', [CASE a WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text], q2
            FROM judged JOIN moves ON a <> 's' WHERE fault IN ('', 'truncated')),
        walk AS (
            SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0::BIGINT, 'audit': '', 'made': []::VARCHAR[]} AS best FROM counted
            UNION ALL
            SELECT w.conv_id, w.i + 1, e.q2, min({'cost': w.best.cost + s.price + e.price, 'audit': w.best.audit || s.audit || e.edit,
                'made': list_concat(list_concat(w.best.made, s.made), e.made)})
            FROM walk AS w JOIN inserts AS s ON w.q = s.q JOIN edits AS e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.q = s.q2
            GROUP BY ALL),
        ended AS (
            SELECT w.conv_id, min({'cost': w.best.cost + s.price, 'audit': w.best.audit || s.audit, 'made': list_concat(w.best.made, s.made)}) AS best
            FROM walk AS w JOIN counted AS c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN inserts AS s ON w.q = s.q
            WHERE s.q2 IN (0, 3) GROUP BY w.conv_id)
        SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
            sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS a LEFT JOIN counted AS c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN ended AS e ON a.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op13_ranked_search": r"""
        WITH words AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        sizes AS (SELECT r, len(terms) AS n FROM words WHERE len(terms) > 0),
        totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
        asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark) GROUP BY ALL),
        lists AS (
            SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, unnest(terms) AS term FROM words) SEMI JOIN asked USING (term) GROUP BY ALL),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
            FROM lists, totals GROUP BY term),
        scored AS (
            SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM asked JOIN lists USING (term) JOIN weights USING (term) JOIN sizes USING (r), totals GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS place FROM scored WHERE score > 0)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 20""",
}
