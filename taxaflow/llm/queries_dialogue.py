"""op12: the contract's damage of conversations, and the digest of their repair."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import table
from taxaflow.llm.dialogue import repair, transcript_digests

COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage by the CRC-32 of conversation and turn, nulls as one space."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).filter("kind <> 0")
    new_text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), new_text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report, turns = repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    found = ids.join(report.drop("conv_id"), "key", "left").join(transcript_digests(turns), "key", "left")
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
#: Backwards over each conversation's rows, the least (cost, audit, lines) of each state of the grammar is carried whole.
#: v0 to v3: nothing yet, after system, after user, after assistant; c is the CRC-32 by its 256 steps of one byte.
ORACLE_SQL = {
    "op12_conversation_repair": r"""
        WITH RECURSIVE steps AS (
            SELECT list_transform(range(256), lambda i: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i::BIGINT)) AS step),
        shown AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        dealt AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT), lambda v, b: xor(v >> 8, step[(xor(v, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS kind
            FROM shown, steps),
        rows AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM dealt WHERE kind <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(coalesce('=' || conv_id, '') || ':' || length(role) || ':' || role || text)) AS n
            FROM rows),
        marked AS (
            SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER w AS before,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
                   right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last
            FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
        faults AS (
            SELECT *, CASE WHEN last = '' THEN 'b' WHEN again THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM marked),
        convs AS (
            SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
                   count(*) FILTER (WHERE before || r NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faults GROUP BY conv_id),
        far AS (SELECT {'cost': 1000000000, 'audit': '', 'lines': ['']} AS far),
        best AS (
            SELECT conv_id, n_rows AS n, {'cost': 0, 'audit': '', 'lines': ['']} AS v0, {'cost': 10, 'audit': 'II', 'lines': ['', 'user:', 'assistant:']} AS v1,
                   {'cost': 5, 'audit': 'I', 'lines': ['', 'assistant:']} AS v2, {'cost': 0, 'audit': '', 'lines': ['']} AS v3
            FROM convs
            UNION ALL
            SELECT conv_id, n, list_min([w0, i2]), list_min([w1, i2]), list_min([w2, i3]), list_min([w3, i2])
            FROM (
                SELECT *, {'cost': w2.cost + 5, 'audit': 'I' || w2.audit, 'lines': ['', 'user:'] || w2.lines[2:]} AS i2,
                       {'cost': w3.cost + 5, 'audit': 'I' || w3.audit, 'lines': ['', 'assistant:'] || w3.lines[2:]} AS i3
                FROM (
                    SELECT conv_id, n,
                           list_min([d0, CASE WHEN free AND r = 's' THEN {'cost': v1.cost + more, 'audit': 'K' || v1.audit, 'lines': ['', role || ':' || text] || v1.lines[2:]} ELSE far END,
                                     CASE WHEN free AND r = 'u' THEN ku ELSE far END, CASE WHEN free THEN ru ELSE far END]) AS w0,
                           list_min([d1, CASE WHEN free AND r = 'u' THEN ku ELSE far END, CASE WHEN free THEN ru ELSE far END]) AS w1,
                           list_min([d2, CASE WHEN free AND r = 'a' THEN ka ELSE far END, CASE WHEN free THEN ra ELSE far END]) AS w2,
                           list_min([d3, CASE WHEN free AND r = 'u' THEN ku ELSE far END, CASE WHEN free THEN ru ELSE far END]) AS w3
                    FROM (
                        SELECT b.conv_id, b.n - 1 AS n, v0, v1, v2, v3, f.role, f.text, f.r, f.fault NOT IN ('b', 'd') AS free, CASE WHEN f.fault = 't' THEN 5 ELSE 0 END AS more, far,
                               {'cost': v0.cost + 2, 'audit': 'D' || v0.audit, 'lines': v0.lines} AS d0, {'cost': v1.cost + 2, 'audit': 'D' || v1.audit, 'lines': v1.lines} AS d1,
                               {'cost': v2.cost + 2, 'audit': 'D' || v2.audit, 'lines': v2.lines} AS d2, {'cost': v3.cost + 2, 'audit': 'D' || v3.audit, 'lines': v3.lines} AS d3,
                               {'cost': v2.cost + more, 'audit': 'K' || v2.audit, 'lines': ['', f.role || ':' || f.text] || v2.lines[2:]} AS ku,
                               {'cost': v3.cost + more, 'audit': 'K' || v3.audit, 'lines': ['', f.role || ':' || f.text] || v3.lines[2:]} AS ka,
                               {'cost': v2.cost + more + 1, 'audit': 'R' || v2.audit, 'lines': ['', 'user:' || f.text] || v2.lines[2:]} AS ru,
                               {'cost': v3.cost + more + 1, 'audit': 'R' || v3.audit, 'lines': ['', 'assistant:' || f.text] || v3.lines[2:]} AS ra
                        FROM best AS b JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.n, far))))
        SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.cost, 0)::BIGINT AS cost, coalesce(v0.audit, '') AS audit,
               sha256(coalesce(array_to_string(v0.lines[2:], chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS i LEFT JOIN convs AS c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
             LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM i.conv_id AND b.n = 0""",
}
