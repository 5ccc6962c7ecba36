"""op11: the contract's digest of documents without shared lines."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaflow.llm.common import table
from taxaflow.llm.lines import drop_shared_lines


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_shared_lines(table(spark, sf_dir, "documents"), least_chars=10, least_docs=2)
    return found.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op11_line_dedup": op11_line_dedup}
ORACLE_SQL = {
    "op11_line_dedup": """
        WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
             l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM t),
             k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
             s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key
                   HAVING count(DISTINCT doc_id) >= 2)
        SELECT doc_id, count(*) AS n_lines,
               CAST(count(*) FILTER (WHERE first <> doc_id) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE first IS NULL OR first = doc_id), ''))
                   AS kept_sha256
        FROM k LEFT JOIN s USING (key) GROUP BY doc_id""",
}
