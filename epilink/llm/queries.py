"""One query for each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epilink.llm import chat_format, decontaminate, exact_dedup, filter_audit, hilbert, html_text, merkle, mixing, order_minhash, pii, quality, secrets_scan, toxicity
from epilink.llm.tables import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.findings(table(spark, sf_dir, "documents")))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold marks of the template and a backslash."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    hard = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat_format.digest(chat_format.read_back(chat_format.format_turns(turns.unionByName(hard))))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), "html", ["page_id"])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, items, ["doc_id"]))


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.digest(hilbert.place(table(spark, sf_dir, "documents")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, held against texts that lost their line ends where 2 divides the checksum of the id."""
    cut = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.COLUMNS]
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), F.when(hit, merkle.leaf(cut)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_secrets,
        op3_toxicity,
        op4_mixing,
        op5_chat_format,
        op6_exact_dedup,
        op7_quality,
        op8_html_text,
        op9_decontamination,
        op10_order_minhash,
        op11_hilbert_shards,
        op12_filter_audit,
        op13_merkle_manifest,
    )
}

#: CRC-32 (fixed polynomial) of the list of bytes ``{}``, for engines without it.
_CRC_STEP = "list_reduce(range(8), lambda a, j: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, {})"
_CRC = f"""xor(4294967295, list_reduce({{}}, lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))"""
_CRC_TABLE = f"SELECT list_transform(range(256), lambda i: {_CRC_STEP.format('i')}) AS crc_table"


def _bytes(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: ('0x' || h)::BIGINT)"


def _hilbert_sql(axes: int = 4, bits: int = 5, shards: int = 16) -> str:
    """Places on the curve: the same steps as nested queries."""
    steps = 1 << bits
    x = [f"x{i}" for i in range(axes)]
    sql = f"""SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size, {_CRC.format(_bytes("coalesce(text, '')"))} AS text_crc32,
        coalesce((SELECT r FROM source_ranks s WHERE s.v = d.source), 0)::BIGINT AS x0, coalesce((SELECT r FROM lang_ranks s WHERE s.v = d.lang), 0)::BIGINT AS x1,
        coalesce(least(floor((doc_id::DOUBLE - least_id) / (most_id - least_id + 1.0) * {steps})::BIGINT, {steps - 1}), 0) AS x2,
        least(length(bin(coalesce(strlen(text), 0) + 1)) - 1, {steps - 1})::BIGINT AS x3
      FROM documents d, crc, (SELECT min(doc_id)::DOUBLE AS least_id, max(doc_id)::DOUBLE AS most_id FROM documents)"""
    keep = "doc_id, size, text_crc32"

    def then(sql: str, new: dict[str, str]) -> str:
        return f"SELECT {keep}, " + ", ".join(f"{new.get(c, c)} AS {c}" for c in x) + f" FROM ({sql})"

    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for c in x:
            swap = f"(xor(x0, {c}) & {low})"
            new = {"x0": f"CASE WHEN ({c} >> {q}) & 1 = 1 THEN xor(x0, {low}) ELSE xor(x0, {swap}) END"}
            if c != "x0":
                new[c] = f"CASE WHEN ({c} >> {q}) & 1 = 1 THEN {c} ELSE xor({c}, {swap}) END"
            sql = then(sql, new)
    for before, c in zip(x, x[1:]):
        sql = then(sql, {c: f"xor({c}, {before})"})
    turn = "0::BIGINT"
    for q in range(1, bits):
        turn = f"xor({turn}, CASE WHEN ({x[-1]} >> {q}) & 1 = 1 THEN {(1 << q) - 1} ELSE 0 END)"
    sql = then(sql, {c: f"xor({c}, {turn})" for c in x})
    index = " + ".join(f"((({c} >> {q}) & 1) << {q * axes + axes - 1 - i})" for q in range(bits) for i, c in enumerate(x))
    ranks = lambda c: f"""{c}_ranks AS (SELECT v, (row_number() OVER (ORDER BY v) - 1) * {steps} // count(*) OVER () AS r
      FROM (SELECT DISTINCT {c} AS v FROM documents WHERE {c} IS NOT NULL))"""
    return f"""WITH crc AS ({_CRC_TABLE}), {ranks('source')}, {ranks('lang')},
      placed AS (SELECT {keep}, row_number() OVER (ORDER BY curve, doc_id NULLS FIRST, text_crc32, size) - 1 AS p, count(*) OVER () AS n
        FROM (SELECT {keep}, {index} AS curve FROM ({sql}))),
      cut AS (SELECT *, p * {shards} // n AS shard FROM placed)
      SELECT {keep}, 'rows' AS law, shard::INT AS shard, p - min(p) OVER (PARTITION BY shard) AS slot, NULL::INT AS grown_shard FROM cut"""


_AUDIT_SQL = r"""
    WITH words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
      marks AS (SELECT part, coalesce(l.quality, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic,
          (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
          + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
          + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false)::INT AS m
        FROM words LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) l ON l.doc_id = words.doc_id),
      kinds AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marks GROUP BY 1, 2),
      f AS (SELECT i::INT AS i, 1 << i::INT AS b FROM range(5) t(i)),
      orders AS (SELECT [f1.i, f2.i, f3.i, f4.i, f5.i] AS o FROM f f1, f f2, f f3, f f4, f f5 WHERE f1.b + f2.b + f3.b + f4.b + f5.b = 31
          AND len(list_distinct([f1.i, f2.i, f3.i, f4.i, f5.i])) = 5),
      steps AS (SELECT o, step::INT AS step, o[step] AS i, coalesce(list_sum(list_transform(o[1:step - 1], lambda k: 1 << k)), 0)::INT AS before
        FROM orders, range(1, 6) t(step)),
      counted AS (SELECT part, o, step, i, sum(n) FILTER ((m & (before | (1 << i))) = 0) AS kept,
          sum(n) FILTER ((m & before) = 0 AND (m >> i) & 1 = 1) AS removed, sum(n) FILTER ((m & before) <> 0 AND (m >> i) & 1 = 1) AS redundant,
          sum(n) FILTER (m = 1 << i) AS unique_fails, sum(good) FILTER ((m & before) = 0 AND (m >> i) & 1 = 1) AS good_lost,
          sum(toxic) FILTER ((m & before) = 0 AND (m >> i) & 1 = 1) AS toxic_lost
        FROM kinds, steps GROUP BY part, o, step, i)
    SELECT part, array_to_string(list_transform(o, lambda k: substr('ABCDE', k + 1, 1)), '') AS filter_order, step, substr('ABCDE', i + 1, 1) AS filter,
      coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
      coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
      coalesce(sum(removed) OVER (PARTITION BY part, i), 0)::BIGINT AS shapley
    FROM counted"""


def _merkle_sql(levels: int = 12, source_levels: int = 6) -> str:
    """Trees of at most 3^12 leaves a source and 3^6 sources, level by level; proofs and folds likewise."""
    field = lambda e: f"coalesce(strlen({e}::VARCHAR)::VARCHAR || ':' || {e}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    crc = _CRC.format(_bytes("doc_id::VARCHAR"))
    ctes = [
        f"crc AS ({_CRC_TABLE})",
        f"""leaves AS (SELECT doc_id, source, {leaf('text')} AS h, CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS t
          FROM documents, crc)""",
        """n0 AS (SELECT dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
          doc_id, h, t, count(*) OVER (PARTITION BY source) AS c FROM leaves)""",
        "f0 AS (SELECT doc_id, h AS leaf, s, i, t AS cur, '' AS proof FROM n0)",
    ]

    def climb(tier: str, k: int) -> None:
        """Runs of tier ``k`` and the nodes above them."""
        ctes.append(f"{tier}r{k} AS (SELECT s, i // 3 AS i, any_value(c) AS c, list(h ORDER BY i) AS hs FROM {tier}{k} GROUP BY s, i // 3)")
        ctes.append(f"""{tier}{k + 1} AS (SELECT s, i, CASE WHEN c > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
          CASE WHEN c > 1 THEN (c + 2) // 3 ELSE 1 END AS c FROM {tier}r{k})""")

    def fold(tier: str, k: int, f: int) -> None:
        left, right = "array_to_string(hs[1:(f.i % 3)::INT], '')", "array_to_string(hs[(f.i % 3 + 2)::INT:], '')"
        ctes.append(f"""f{f + 1} AS (SELECT doc_id, leaf, f.s, f.i // 3 AS i, CASE WHEN c > 1 THEN sha256({left} || cur || {right}) ELSE cur END AS cur,
          proof || CASE WHEN c > 1 THEN {left} || {right} ELSE '' END AS proof FROM f{f} f JOIN {tier}r{k} r ON r.s = f.s AND r.i = f.i // 3)""")

    for k in range(levels):
        climb("n", k)
        fold("n", k, k)
    ctes.append(f"m0 AS (SELECT 0 AS s, s AS i, h, (SELECT count(*) FROM n{levels}) AS c FROM n{levels})")
    ctes.append(f"g AS (SELECT doc_id, leaf, s AS source_no, 0 AS s, s AS i, cur, proof FROM f{levels})")
    f = levels
    for k in range(source_levels):
        climb("m", k)
        left, right = "array_to_string(hs[1:(f.i % 3)::INT], '')", "array_to_string(hs[(f.i % 3 + 2)::INT:], '')"
        of = "g" if k == 0 else f"g{k}"
        ctes.append(f"""g{k + 1} AS (SELECT doc_id, leaf, source_no, f.i // 3 AS i, CASE WHEN c > 1 THEN sha256({left} || cur || {right}) ELSE cur END AS cur,
          proof || CASE WHEN c > 1 THEN {left} || {right} ELSE '' END AS proof FROM {of} f JOIN mr{k} r ON r.i = f.i // 3)""")
    return f"""WITH {", ".join(ctes)}
      SELECT doc_id, leaf, m0.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root.h AS verified
      FROM g{source_levels} g JOIN m0 ON m0.i = g.source_no, m{source_levels} root"""


ORACLE: dict[str, str] = {
    "op6_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
          doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        WINDOW w AS (PARTITION BY t)""",
    "op11_hilbert_shards": _hilbert_sql(),
    "op12_filter_audit": _AUDIT_SQL,
    "op13_merkle_manifest": _merkle_sql(),
}
