"""Registered queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and the
matching DuckDB SQL in ``ORACLE[name]``.

Every query reads the driver's tables (or files Spark writes from them), so
its work grows with the scale factor.  Parameters below are fixed values of
the catalogue, shared by both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fileflow.functions.strftime import path_time, templated_path_column
from fileflow.operators import chunks as CH
from fileflow.operators import ranges as R
from fileflow.operators.ordered import with_global_index
from fileflow.operators.packing import task_concat, task_entries, task_pack, task_summary
from fileflow.plans.manifest import MANIFEST_SQL, manifest, table
from fileflow.session import scratch_path
from fileflow.sources import quarantine as Q

# Fixed values of the catalogue (same on the Spark and the SQL side).
PLAN_TARGET = 1024            # approximate number of ranges of the manifest plan
PLAN_REGEX = r"^/src[0-9]*[02468]/(en|de|fr)/"
CHUNK_TARGET = 4000           # approximate number of line chunks over all documents
HEADER_LINES = 2
RANGE_LIMIT = 500
FILE_LIMIT = 100
PACK_MIN = 8000               # min_task_size for packing plan ranges (bytes)
CONCAT_MIN = 20000            # min_task_size for packing text chunks (bytes)
NULL_SOURCE = "src3"          # the source whose key is made null
URL_REGEX = r"^https?://(m\.|blog\.)?[a-z]+\.example\.(com|org)/(en|fr)/[0-9]+"
PATH_TEMPLATE = "/logs/%Y/%m/%d/%H/%Y%m%d-%H%M%S-%j-%a-%b-%p%I-%u%w-%U%W%V.%s"
REWIND_SECONDS = 86400

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _docs(spark, sf):
    return table(spark, sf, "documents")


def _plan(spark, sf, regex=None) -> DataFrame:
    return R.range_plan(manifest(_docs(spark, sf)), PLAN_TARGET, path_regex=regex)


def _with_source(plan: DataFrame) -> DataFrame:
    return plan.withColumn("source", F.split(F.col("path_string"), "/").getItem(1))


# ---------------------------------------------------------------- SQL pieces

CODEC_SQL = R.codec_suffix_regex()


def plan_ctes(n: int = PLAN_TARGET, regex: str | None = None) -> str:
    where = f"WHERE regexp_matches(path_string, '{regex}')" if regex else ""
    return f"""{MANIFEST_SQL},
u AS (SELECT CAST(sum(length) AS BIGINT) AS total_bytes,
             greatest(CAST(sum(length) AS BIGINT) // {n}, 1) AS unit FROM m),
f AS (SELECT path, length, regexp_matches(path, '{CODEC_SQL}') AS dec FROM m WHERE length > 0),
g AS (SELECT path, length, dec, NOT dec AS part,
             CASE WHEN NOT dec THEN (length - 1) // unit + 1 ELSE 1 END AS n FROM f, u),
x AS (SELECT path, length, dec, part, n, unnest(range(n)) AS i FROM g),
plan0 AS (SELECT path AS path_string, length * i // n AS start, length * (i + 1) // n AS "end",
                 dec AS is_decompressible, part AS is_partitionable,
                 CAST(0 AS INTEGER) AS num_header_lines,
                 length * (i + 1) // n - length * i // n AS size FROM x),
plan AS (SELECT * FROM plan0 {where})"""


PLAN_COLS = 'path_string, start, "end", is_decompressible, is_partitionable, num_header_lines, size'


def pack_ctes(entries: str, group: str, order: str, m: int) -> str:
    """Greedy packing as a recursive CTE over ``entries`` (oracle side)."""
    return f"""
e AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) - 1 AS range_index
      FROM {entries}),
r AS (SELECT {group}, range_index, size AS acc, CAST(0 AS BIGINT) AS task_id
      FROM e WHERE range_index = 0
      UNION ALL
      SELECT e.{group}, e.range_index,
             CASE WHEN r.acc >= {m} THEN e.size ELSE r.acc + e.size END,
             CASE WHEN r.acc >= {m} THEN r.task_id + 1 ELSE r.task_id END
      FROM r JOIN e ON e.{group} = r.{group} AND e.range_index = r.range_index + 1),
packed AS (SELECT e.*, r.task_id FROM e JOIN r USING ({group}, range_index))"""


LINE_SQL = r"[^\r\n]*(?:\r\n|\r|\n)|[^\r\n]+"


def chunk_ctes(target: int = CHUNK_TARGET, header: int = 0, extra: str = "") -> str:
    """Line chunks by the closed form: a line starting at byte b goes to chunk
    ((b+1)*n-1) div len; header lines go to chunk 0."""
    return f"""
d AS (SELECT doc_id{extra}, text, CAST(strlen(text) AS BIGINT) AS len FROM documents),
du AS (SELECT greatest(CAST(sum(len) AS BIGINT) // {target}, 1) AS unit FROM d),
dn AS (SELECT d.*, (len - 1) // unit + 1 AS n,
              regexp_extract_all(text, '{LINE_SQL}', 0) AS ls FROM d, du WHERE len > 0),
ln AS (SELECT doc_id{extra}, len, n, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM dn),
lb AS (SELECT *, CAST(coalesce(sum(strlen(line)) OVER (PARTITION BY doc_id ORDER BY line_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b,
              regexp_matches(line, '[\\r\\n]$') AS terminated FROM ln),
lh AS (SELECT *, bool_and(terminated) OVER (PARTITION BY doc_id ORDER BY line_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS all_term FROM lb),
lc AS (SELECT *, (line_no < {header} AND all_term) AS is_hdr,
              CASE WHEN line_no < {header} AND all_term THEN 0
                   ELSE ((b + 1) * n - 1) // len END AS c FROM lh),
hd AS (SELECT doc_id, coalesce(string_agg(line, '' ORDER BY line_no) FILTER (WHERE is_hdr), '') AS hdr
       FROM lc GROUP BY doc_id),
ch AS (SELECT lc.doc_id{extra.replace(', ', ', lc.')}, CAST(c AS BIGINT) AS chunk_index,
              CAST(min(b) AS BIGINT) AS start, CAST(max(b + strlen(line)) AS BIGINT) AS "end",
              string_agg(line, '' ORDER BY line_no) AS body
       FROM lc GROUP BY ALL)"""


# ---------------------------------------------------------------- F / A / T

@register("skip_empty", f"WITH {MANIFEST_SQL} SELECT path, length FROM m WHERE length > 0")
def q_skip_empty(spark, sf):
    return manifest(_docs(spark, sf)).where(F.col("length") > 0)


@register("path_regex_filter",
          f"SELECT page_id, url FROM pages WHERE regexp_matches(url, '{URL_REGEX}')")
def q_path_regex_filter(spark, sf):
    return table(spark, sf, "pages").select("page_id", "url").where(F.col("url").rlike(URL_REGEX))


@register("codec_flags", f"""WITH {MANIFEST_SQL}
SELECT path, regexp_matches(path, '{CODEC_SQL}') AS is_decompressible,
       NOT regexp_matches(path, '{CODEC_SQL}') AS is_partitionable FROM m""")
def q_codec_flags(spark, sf):
    return R.codec_flags(manifest(_docs(spark, sf))).select("path", "is_decompressible",
                                                            "is_partitionable")


@register("total_size", f"WITH {MANIFEST_SQL} SELECT CAST(sum(length) AS BIGINT) AS total_bytes FROM m")
def q_total_size(spark, sf):
    return R.total_size(manifest(_docs(spark, sf)))


@register("unit_size", f"WITH {plan_ctes()} SELECT total_bytes, unit FROM u")
def q_unit_size(spark, sf):
    return R.unit_size(manifest(_docs(spark, sf)), PLAN_TARGET)


@register("range_count", f"WITH {plan_ctes()} SELECT path, length, n AS n_ranges FROM g")
def q_range_count(spark, sf):
    inv = manifest(_docs(spark, sf))
    unit = R.unit_column(inv, PLAN_TARGET)
    live = R.codec_flags(inv.where(F.col("length") > 0))
    return R.range_count(live, unit).select("path", "length", "n_ranges")


@register("range_plan", f"WITH {plan_ctes()} SELECT * FROM plan")
def q_range_plan(spark, sf):
    return _plan(spark, sf)


@register("range_plan_regex", f"WITH {plan_ctes(regex=PLAN_REGEX)} SELECT * FROM plan")
def q_range_plan_regex(spark, sf):
    return _plan(spark, sf, PLAN_REGEX)


@register("range_invariants", f"""WITH {plan_ctes()},
bad AS (SELECT path, length, dec, (length - 1) // unit + 1 AS n FROM f, u),
bx AS (SELECT path, length, dec, n, unnest(range(n)) AS i FROM bad),
bp AS (SELECT path AS path_string, length * i // n AS start, length * (i + 1) // n AS "end",
              dec, TRUE AS part FROM bx)
SELECT path_string, start, "end", 'decompressible_and_partitionable' AS rule FROM bp WHERE dec AND part
UNION ALL
SELECT path_string, start, "end", 'decompressible_with_nonzero_start' FROM bp WHERE dec AND start <> 0
UNION ALL
SELECT path_string, start, "end", 'field_absent' FROM bp WHERE "end" % 7 = 0""")
def q_range_invariants(spark, sf):
    # A plan built as if the codec did not stop splitting (the reference's
    # decompression=false + partition=true case, with codec flags set): every
    # compressed file breaks a rule, later ranges of them break two.
    inv = manifest(_docs(spark, sf))
    unit = R.unit_column(inv, PLAN_TARGET)
    flagged = R.codec_flags(inv.where(F.col("length") > 0)).withColumn("is_partitionable", F.lit(True))
    bad = R.explode_ranges(R.range_count(flagged, unit))
    # one range in seven lacks its number of header lines
    bad = bad.withColumn("num_header_lines", F.when(F.col("end") % 7 != 0, F.col("num_header_lines")))
    return R.range_invariants(bad)


@register("range_limit", f"WITH {plan_ctes()} SELECT * FROM plan ORDER BY path_string, start LIMIT {RANGE_LIMIT}")
def q_range_limit(spark, sf):
    return R.range_limit(_plan(spark, sf), RANGE_LIMIT)


@register("file_limit", f"""WITH {plan_ctes()},
fl AS (SELECT DISTINCT path_string FROM plan ORDER BY path_string LIMIT {FILE_LIMIT})
SELECT * FROM plan WHERE path_string IN (SELECT path_string FROM fl)""")
def q_file_limit(spark, sf):
    return R.file_limit(_plan(spark, sf), FILE_LIMIT)


@register("range_index", f"""WITH {plan_ctes()}
SELECT *, row_number() OVER (ORDER BY path_string, start) - 1 AS range_index FROM plan""")
def q_range_index(spark, sf):
    return with_global_index(_plan(spark, sf), ["path_string", "start"], "range_index")


@register("last_range", f"""WITH {plan_ctes(regex=PLAN_REGEX)}
SELECT * FROM plan ORDER BY path_string DESC, start DESC LIMIT 1""")
def q_last_range(spark, sf):
    return R.last_range(_plan(spark, sf, PLAN_REGEX))


def _packed(spark, sf, with_position=False):
    plan = _with_source(_plan(spark, sf))
    return task_pack(plan, ["source"], ["path_string", "start"], "size", PACK_MIN,
                     with_position=with_position)


PACK_SQL = f"""WITH RECURSIVE {plan_ctes()},
src AS (SELECT *, split_part(path_string, '/', 2) AS source FROM plan),
{pack_ctes('src', 'source', 'path_string, start', PACK_MIN)}"""


@register("task_pack", f"SELECT {PLAN_COLS}, source, range_index, task_id FROM ({PACK_SQL} SELECT * FROM packed)")
def q_task_pack(spark, sf):
    return _packed(spark, sf)


@register("task_pack_null_group", f"""
SELECT {PLAN_COLS}, NULLIF(source, '{NULL_SOURCE}') AS source, range_index, task_id FROM ({PACK_SQL} SELECT * FROM packed)""")
def q_task_pack_null_group(spark, sf):
    # a null key is a group like any other
    plan = _with_source(_plan(spark, sf)).withColumn("source", F.nullif(F.col("source"), F.lit(NULL_SOURCE)))
    return task_pack(plan, ["source"], ["path_string", "start"], "size", PACK_MIN)


@register("task_summary", f"""{PACK_SQL}
SELECT source, task_id, count(*) AS n_entries, CAST(sum(size) AS BIGINT) AS task_size,
       min(range_index) AS first_index, max(range_index) AS last_index
FROM packed GROUP BY source, task_id""")
def q_task_summary(spark, sf):
    return task_summary(_packed(spark, sf), ["source"])


@register("task_entries", f"""{PACK_SQL}
SELECT {PLAN_COLS}, source, range_index, task_id,
       range_index - min(range_index) OVER (PARTITION BY source, task_id) AS position_in_task
FROM packed""")
def q_task_entries(spark, sf):
    return task_entries(_packed(spark, sf, with_position=True), ["source"])


@register("task_concat", f"""WITH RECURSIVE {chunk_ctes(extra=', source')},
pieces AS (SELECT source, doc_id, chunk_index, body AS chunk, "end" - start AS size FROM ch),
{pack_ctes('pieces', 'source', 'doc_id, chunk_index', CONCAT_MIN)}
SELECT source, task_id, string_agg(chunk, '' ORDER BY range_index) AS chunk, count(*) AS n_pieces
FROM packed GROUP BY source, task_id""")
def q_task_concat(spark, sf):
    pieces = CH.line_chunks(_docs(spark, sf), keys=("source", "doc_id"), target_ranges=CHUNK_TARGET)
    pieces = pieces.withColumn("size", F.col("end") - F.col("start"))
    packed = task_pack(pieces, ["source"], ["doc_id", "chunk_index"], "size", CONCAT_MIN)
    return task_concat(packed, ["source"], "chunk")


# ---------------------------------------------------------------- L / P

@register("split_lines", f"""
SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line
FROM (SELECT doc_id, regexp_extract_all(text, '{LINE_SQL}', 0) AS ls FROM documents)""")
def q_split_lines(spark, sf):
    return CH.lines(_docs(spark, sf)).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


@register("line_chunks", f"""WITH {chunk_ctes()}
SELECT doc_id, chunk_index, start, "end", body AS chunk FROM ch""")
def q_line_chunks(spark, sf):
    return CH.line_chunks(_docs(spark, sf), target_ranges=CHUNK_TARGET)


@register("line_chunks_header", f"""WITH {chunk_ctes(header=HEADER_LINES)}
SELECT ch.doc_id, chunk_index, start, "end",
       CASE WHEN chunk_index > 0 THEN hd.hdr || body ELSE body END AS chunk
FROM ch JOIN hd USING (doc_id)""")
def q_line_chunks_header(spark, sf):
    return CH.line_chunks(_docs(spark, sf), target_ranges=CHUNK_TARGET, header_lines=HEADER_LINES)


_TEMPLATE_SQL = PATH_TEMPLATE.replace("%s", "")
assert PATH_TEMPLATE.endswith("%s")


@register("templated_path_column", f"""
SELECT event_id,
       strftime(ts - INTERVAL {REWIND_SECONDS} SECOND, '{_TEMPLATE_SQL}')
         || CAST(CAST(floor(epoch(ts - INTERVAL {REWIND_SECONDS} SECOND)) AS BIGINT) AS VARCHAR) AS path
FROM events""")
def q_templated_path_column(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", templated_path_column(F.col("ts"), PATH_TEMPLATE, REWIND_SECONDS).alias("path"))


# ---------------------------------------------------------------- S: scans over staged files

from fileflow.options import IngestOptions  # noqa: E402
from fileflow.plans.ingest import read_ingest  # noqa: E402
from fileflow.plans.staging import staged  # noqa: E402
from fileflow.sources import delimited as D  # noqa: E402
from fileflow.sources import inventory as INV  # noqa: E402
from fileflow.sources import scans as SC  # noqa: E402
from fileflow.sources import codecs as CO  # noqa: E402
from fileflow.sources import members as ME  # noqa: E402
from fileflow.sources import splits as SP  # noqa: E402

# CSV dialect of staged files and the NTZ timestamp text format.
CSV = {"quote": '"', "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
PART_SCHEMA = ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
               "p_retailprice DOUBLE")
ORDERS_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                 "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")
CUSTOMER_SCHEMA = ("c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                   "c_mktsegment STRING")
EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
                 "props STRING")
TEMPLATE_NOW = "2024-01-17 00:30:00"     # injected 'now' of the templated scan
TEMPLATE_REWIND = 86400
INGEST_NOW = "1997-07-01 12:00:00"       # injected 'now' of the ingest
EVENTS_TEMPLATE = "day=%Y-%m-%d"         # one day folder of many


def _part_tree(spark, sf):
    def write(path):
        part = table(spark, sf, "part")
        (part.withColumn("type", F.lower("p_type"))
             .withColumn("band", F.concat(F.lit("size"), F.call_function("div", F.col("p_size"), F.lit(10))
                                          .cast("string")))
             .write.mode("overwrite").partitionBy("type", "band").options(**CSV).csv(path))
    return staged(spark, sf, "part_tree", write)


@register("scan_recursive_glob", "SELECT * FROM part")
def q_scan_recursive_glob(spark, sf):
    root = _part_tree(spark, sf)
    # the glob matches the first level of folders; the scan descends the rest
    return SC.read_csv(spark, f"{root}/type=*", PART_SCHEMA, recursive=True, **CSV)


def _orders_csv(spark, sf):
    def write(path):
        table(spark, sf, "orders").hint("rebalance").write.mode("overwrite").options(**CSV).csv(path)
    return staged(spark, sf, "orders_csv", write)


@register("scan_split_lines", "SELECT * FROM orders")
def q_scan_split_lines(spark, sf):
    return SC.read_csv(spark, _orders_csv(spark, sf), ORDERS_SCHEMA, **CSV)


def _orders_records(spark, sf):
    def write(path):
        o = table(spark, sf, "orders")
        two_lines = F.concat("o_orderpriority", F.lit(",\n\""), "o_orderstatus", F.lit('"'))
        o.withColumn("o_orderpriority", two_lines).hint("rebalance").write.mode("overwrite").options(**CSV).csv(path)
    return staged(spark, sf, "orders_records", write)


@register("scan_whole_file", """
SELECT * REPLACE (o_orderpriority || ',' || chr(10) || '"' || o_orderstatus || '"' AS o_orderpriority) FROM orders""")
def q_scan_whole_file(spark, sf):
    # multiLine makes every file one unsplit stream (reference: partition: false), so quoted line ends stay
    return SC.read_csv(spark, _orders_records(spark, sf), ORDERS_SCHEMA, multiLine=True, **CSV)


def _customer_codecs(spark, sf):
    def write(path):
        cust = table(spark, sf, "customer")
        seg = F.col("c_mktsegment")
        first, second = seg.isin("MACHINERY", "BUILDING"), seg.isin("AUTOMOBILE", "HOUSEHOLD")
        rest = F.coalesce(~(first | second), F.lit(True))
        for codec, cond in (("gzip", first), ("bzip2", second), ("none", rest)):
            (cust.where(F.coalesce(cond, F.lit(False))).write.mode("overwrite")
                 .option("compression", codec).options(**CSV).csv(f"{path}/{codec}"))
    return staged(spark, sf, "customer_codecs", write)


@register("scan_compressed", "SELECT * FROM customer")
def q_scan_compressed(spark, sf):
    return SC.read_csv(spark, _customer_codecs(spark, sf), CUSTOMER_SCHEMA, recursive=True, **CSV)


def _documents_text(spark, sf):
    def write(path):
        (_docs(spark, sf).select("source", "lang", "text").hint("rebalance", "source", "lang")
            .write.mode("overwrite").partitionBy("source", "lang").text(path))
    return staged(spark, sf, "documents_text", write)


@register("file_inventory", """
SELECT source, lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY source, lang""")
def q_file_inventory(spark, sf):
    inv = INV.list_files(spark, f"{_documents_text(spark, sf)}/*", recursive=True)
    return (inv.select(F.regexp_extract("path", r"/source=([^/]+)/", 1).alias("source"),
                       F.regexp_extract("path", r"/lang=([^/]+)/", 1).alias("lang"), "length")
               .groupBy("source", "lang").agg(F.sum("length").cast("long").alias("bytes")))


def _events_by_day(spark, sf):
    def write(path):
        ev = table(spark, sf, "events")
        (ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).hint("rebalance", "day")
           .write.mode("overwrite").partitionBy("day").options(**CSV).csv(path))
    return staged(spark, sf, "events_by_day", write)


@register("scan_templated_path", f"""
SELECT * FROM events
WHERE CAST(ts AS DATE) = CAST(TIMESTAMP '{TEMPLATE_NOW}' - INTERVAL {TEMPLATE_REWIND} SECOND AS DATE)""")
def q_scan_templated_path(spark, sf):
    import datetime as dt

    root = _events_by_day(spark, sf)
    now = dt.datetime.fromisoformat(TEMPLATE_NOW)
    paths = SC.templated_paths(f"{root}/{EVENTS_TEMPLATE}", now, TEMPLATE_REWIND)
    return SC.read_csv(spark, paths, EVENTS_SCHEMA, recursive=False, **CSV)


def _supplier_with_headers(spark, sf):
    def write(path):
        sup = table(spark, sf, "supplier")
        # a file per nation and 1,000 keys: files do not grow with the table
        file = F.concat_ws("-", "s_nationkey", F.call_function("div", F.col("s_suppkey"), F.lit(1000)).cast("string"))
        data = sup.select(
            file.alias("_f"), (F.col("s_suppkey") + 2).alias("_o"),
            F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name",
                        F.col("s_nationkey").cast("string"), F.col("s_acctbal").cast("string")).alias("value"))
        heads = sup.select(file.alias("_f")).distinct().select(
            "_f", F.posexplode(F.array(F.lit("s_suppkey,s_name,s_nationkey,s_acctbal"),
                                       F.lit("# exported from supplier"))).alias("_o", "value"))
        lines = data.unionByName(heads.select("_f", F.col("_o").cast("long").alias("_o"), "value"))
        (lines.repartition("_f").sortWithinPartitions("_f", "_o").select("_f", "value")
              .write.mode("overwrite").partitionBy("_f").text(path))
    return staged(spark, sf, "supplier_headers", write)


@register("skip_header_lines", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_skip_header_lines(spark, sf):
    cols = [D.Col("s_suppkey", "long"), D.Col("s_name"), D.Col("s_nationkey", "int"),
            D.Col("s_acctbal", "double")]
    return D.read_delimited(spark, _supplier_with_headers(spark, sf), cols, header_lines=2)


@register("skip_header_lines_exact", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def q_skip_header_lines_exact(spark, sf):
    # the exact mode: first splits ranked per file, other splits untouched
    cols = [D.Col("s_suppkey", "long"), D.Col("s_name"), D.Col("s_nationkey", "int"),
            D.Col("s_acctbal", "double")]
    return D.read_delimited(spark, _supplier_with_headers(spark, sf), cols, header_lines=2,
                            header_mode="exact")


def _orders_typed(spark, sf):
    def write(path):
        o = table(spark, sf, "orders")
        (o.select("o_orderkey", "o_custkey",
                  F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("time"),
                  F.date_format("o_orderdate", "yyyyMMdd").alias("purchase"),
                  F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"')).alias("comment"),
                  "o_totalprice")
          .hint("rebalance").write.mode("overwrite").option("header", True).options(**CSV).csv(path))
    return staged(spark, sf, "orders_typed", write)


@register("delimited_typed", """
SELECT o_orderkey, o_custkey, o_orderdate AS time, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS purchase,
       o_orderpriority || ', "' || o_orderstatus || '"' AS comment, o_totalprice FROM orders""")
def q_delimited_typed(spark, sf):
    cols = [D.Col("o_orderkey", "long"), D.Col("o_custkey", "long"),
            D.Col("time", "timestamp", "%Y-%m-%d %H:%M:%S"), D.Col("purchase", "timestamp", "%Y%m%d"),
            D.Col("comment", "string"), D.Col("o_totalprice", "double")]
    return D.read_delimited(spark, _orders_typed(spark, sf), cols, sep=",", quote='"', escape='"',
                            header_lines=1, timestamp_ntz=True)


def _part_lines(spark, sf, name, line):
    def write(path):
        table(spark, sf, "part").select(line.alias("value")).write.mode("overwrite").text(path)
    return staged(spark, sf, name, write)


@register("delimited_trim", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '  ' || p_brand || ' ' END AS brand
FROM part""")
def q_delimited_trim(spark, sf):
    key, brand = F.col("p_partkey").cast("string"), F.col("p_brand")
    line = F.when(F.col("p_partkey") % 2 == 0, F.concat(key, F.lit(",  "), brand, F.lit(" "))) \
            .otherwise(F.concat(key, F.lit(',"  '), brand, F.lit(' "')))
    path = _part_lines(spark, sf, "part_trim", line)
    return D.read_delimited(spark, path, [D.Col("id", "long"), D.Col("brand")], trim_if_not_quoted=True)


@register("delimited_ragged", """
SELECT CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE p_partkey END AS id,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS name,
       CASE p_partkey % 5 WHEN 0 THEN 'missing_columns' WHEN 1 THEN 'extra_columns'
            WHEN 2 THEN 'extra_columns' WHEN 3 THEN 'bad_value' ELSE 'ok' END AS row_status
FROM part""")
def q_delimited_ragged(spark, sf):
    path = _part_ragged(spark, sf)
    return D.read_delimited(spark, path, [D.Col("id", "long"), D.Col("name")],
                            allow_extra_columns=True, allow_optional_columns=True,
                            on_bad_row="null", with_status=True)


def _part_ragged(spark, sf):
    key, brand, r = F.col("p_partkey").cast("string"), F.col("p_brand"), F.col("p_partkey") % 5
    line = (F.when(r == 0, key)
             .when(r == 1, F.concat(key, F.lit(","), brand, F.lit(",x")))
             .when(r == 2, F.concat(key, F.lit(","), brand, F.lit(",")))
             .when(r == 3, F.concat(F.lit("x"), key, F.lit(","), brand))
             .otherwise(F.concat(key, F.lit(","), brand)))
    return _part_lines(spark, sf, "part_ragged", line)


@register("delimited_quarantine", """
SELECT CASE WHEN r IN (0, 4) THEN p_partkey END AS id, CASE WHEN r = 4 THEN p_brand END AS name,
       CASE r WHEN 1 THEN 'extra_columns' WHEN 2 THEN 'extra_columns' WHEN 3 THEN 'bad_value' END AS reason,
       CASE r WHEN 1 THEN p_partkey || ',' || p_brand || ',x' WHEN 2 THEN p_partkey || ',' || p_brand || ','
              WHEN 3 THEN 'x' || p_partkey || ',' || p_brand END AS line,
       CAST(CASE WHEN r IN (0, 4) THEN sum(CASE WHEN r IN (0, 4) THEN 1 ELSE 0 END) OVER ()
                 ELSE sum(CASE WHEN r IN (0, 4) THEN 0 ELSE 1 END) OVER () END AS BIGINT) AS counted
FROM (SELECT *, p_partkey % 5 AS r FROM part)""")
def q_delimited_quarantine(spark, sf):
    out = scratch_path(spark, "quarantine")
    lines = Q.placed_lines(spark, _part_ragged(spark, sf))
    for _ in range(2):  # a retry of the batch replaces it
        n = Q.write_rows(lines, [D.Col("id", "long"), D.Col("name")], out, 0, allow_optional_columns=True)
    good, bad = Q.good_rows(spark, out, "id long, name string"), Q.bad_rows(spark, out)
    none = F.lit(None).cast("string")
    return (good.select("id", "name", none.alias("reason"), none.alias("line"), F.lit(n["good"]).cast("long").alias("counted"))
            .unionAll(bad.select(F.lit(None).cast("long").alias("id"), none.alias("name"), "reason", "line", F.lit(n["bad"]).cast("long").alias("counted"))))


def _customer_gzip(spark, sf):
    def write(path):
        (table(spark, sf, "customer").write.mode("overwrite").option("compression", "gzip")
            .options(**CSV).csv(path))
    return staged(spark, sf, "customer_gzip", write)


@register("scan_gzip_any_name", "SELECT * FROM customer")
def q_scan_gzip_any_name(spark, sf):
    # decoded by content, not by suffix (the reader never looks at the name)
    lines = SC.read_gzip_any_name(spark, _customer_gzip(spark, sf))
    lines = lines.select(F.regexp_replace("line", r"(\r\n|\r|\n)$", "").alias("value"))
    cols = [D.Col("c_custkey", "long"), D.Col("c_name"), D.Col("c_nationkey", "int"),
            D.Col("c_acctbal", "double"), D.Col("c_mktsegment")]
    return D.parse_delimited(lines, cols)


def _documents_quoted(spark, sf):
    """Per document: id, its text as one quoted field with quotes doubled, its language with quotes inside."""
    def write(path):
        text = F.replace(F.regexp_replace(F.coalesce("text", F.lit("")), "[\\r\\n]", " "), F.lit('"'), F.lit('""'))
        line = F.concat(F.col("doc_id").cast("string"), F.lit(',"'), text, F.lit('",'), F.coalesce("lang", F.lit("")), F.lit('" x" '))
        _docs(spark, sf).select(line.alias("value")).write.mode("overwrite").text(path)
    return staged(spark, sf, "documents_quoted", write)


@register("delimited_quotes", """
SELECT doc_id, nullif(regexp_replace(coalesce(text, ''), '[\r\n]', ' ', 'g'), '') AS body, coalesce(lang, '') || '" x" ' AS mark,
       'ok' AS row_status FROM documents""")
def q_delimited_quotes(spark, sf):
    cols = [D.Col("doc_id", "long"), D.Col("body"), D.Col("mark")]
    rows = D.read_delimited(spark, _documents_quoted(spark, sf), cols, with_status=True)
    return rows.withColumn("body", F.nullif("body", F.lit("")))


def _part_latin(spark, sf):
    def write(path):
        line = F.concat(F.col("p_partkey").cast("string"), F.lit(",caf\u00e9 "), F.col("p_brand"))
        table(spark, sf, "part").select(line.alias("value")).write.mode("overwrite").option(
            "encoding", "ISO-8859-1").option("quote", "\u0000").option("sep", "\u0001").csv(path)
    return staged(spark, sf, "part_latin", write)


@register("delimited_charset", "SELECT p_partkey AS id, 'caf\u00e9 ' || p_brand AS name FROM part")
def q_delimited_charset(spark, sf):
    return D.read_delimited(spark, _part_latin(spark, sf), [D.Col("id", "long"), D.Col("name")], encoding="ISO-8859-1")


@register("ingest_rows", f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = strftime(TIMESTAMP '{INGEST_NOW}' - INTERVAL {TEMPLATE_REWIND} SECOND, '%Y-%m')
  AND o_orderstatus <> 'F'""")
def q_ingest_rows(spark, sf):
    import datetime as dt

    def write(path):
        o = table(spark, sf, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
        (o.select("month", F.col("o_orderstatus").alias("status"), "o_orderkey", "o_custkey")
          .hint("rebalance", "month", "status").write.mode("overwrite").partitionBy("month", "status")
          .option("header", True).csv(path))
    root = staged(spark, sf, "orders_by_month", write)
    opts = IngestOptions(path=f"{root}/month=%Y-%m", rewind_seconds=TEMPLATE_REWIND, header_lines=1,
                         path_regex="/status=[^F]/", fail_if_empty=True)
    return read_ingest(spark, opts, [D.Col("o_orderkey", "long"), D.Col("o_custkey", "long")],
                       now=dt.datetime.fromisoformat(INGEST_NOW))


# ---------------------------------------------------------------- state carried over splits

QUOTED_SPLITS = 24                       # about so many splits of the staged files
LINES_PER_FILE = 500                     # doc_ids a staged file of lines
MAX_RANGES = 40                          # ranges of the ingest cut by max_ranges
RANGES_TARGET = 64


def _documents_csv(spark, sf):
    def write(path):
        docs = _docs(spark, sf).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
        docs.write.mode("overwrite").option("quoteAll", True).option("header", True).options(**CSV).csv(path)
    return staged(spark, sf, "documents_csv", write)


@register("scan_quoted_splits", """
SELECT doc_id, nullif(text, '') AS body, nullif(lang, '') AS lang, 'ok' AS row_status FROM documents""")
def q_scan_quoted_splits(spark, sf):
    # quoted line ends, and no file read as one task
    path = _documents_csv(spark, sf)
    total = INV.list_files(spark, path).agg(F.sum("length")).first()[0] or 0
    rows = D.read_delimited(spark, path, [D.Col("doc_id", "long"), D.Col("body"), D.Col("lang")], header_lines=1, multi_line="split",
                            split_bytes=min(max(total // QUOTED_SPLITS, 1 << 16), 128 << 20), with_status=True)
    return rows.withColumn("body", F.nullif("body", F.lit(""))).withColumn("lang", F.nullif("lang", F.lit("")))


def _document_lines(spark, sf):
    """A file per source and run of doc_ids: the lines of their texts, in order."""
    def write(path):
        docs = _docs(spark, sf)
        file = F.concat(F.coalesce("source", F.lit("")), F.lit("-"),
                        F.call_function("div", F.col("doc_id"), F.lit(LINES_PER_FILE)).cast("string"))
        lines = docs.select(file.alias("_f"), "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "value"))
        # files are moved by the tasks that write them, not one after the other by the driver
        (lines.repartition("_f").sortWithinPartitions("_f", "doc_id", "pos").select("_f", "value")
              .write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("_f").text(path))
    return staged(spark, sf, "document_lines", write)


_LINES_SQL = f"""
docs AS (SELECT coalesce(source, '') || '-' || CAST(doc_id // {LINES_PER_FILE} AS VARCHAR) AS f, doc_id,
                string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT f, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs)"""


@register("line_offsets", f"""WITH {_LINES_SQL}
SELECT f, CAST(row_number() OVER w - 1 AS BIGINT) AS line_no,
       CAST(coalesce(sum(strlen(line) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS line_start,
       CAST(strlen(line) + 1 AS BIGINT) AS line_bytes, line
FROM lines WINDOW w AS (PARTITION BY f ORDER BY doc_id, pos)""")
def q_line_offsets(spark, sf):
    path = _document_lines(spark, sf)
    total = INV.list_files(spark, path).agg(F.sum("length")).first()[0] or 0
    rows = SP.lines_with_offsets(spark, path, split_bytes=min(max(total // QUOTED_SPLITS, 1 << 16), 128 << 20))
    return rows.select(F.regexp_extract("path", r"/_f=([^/]+)/", 1).alias("f"), "line_no", "line_start", "line_bytes",
                       F.col("value").alias("line"))


@register("file_lengths", f"""WITH {_LINES_SQL}
SELECT f, CAST(sum(strlen(line) + 1) AS BIGINT) AS length FROM lines GROUP BY f""")
def q_file_lengths(spark, sf):
    inv = INV.list_files(spark, _document_lines(spark, sf))
    return inv.select(F.regexp_extract("path", r"/_f=([^/]+)/", 1).alias("f"), "length")


def _order_lines(spark, sf):
    """A file per month and million keys: order lines in key order."""
    def write(path):
        o = table(spark, sf, "orders")
        file = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-"),
                        F.call_function("div", F.col("o_orderkey"), F.lit(1_000_000)).cast("string"))
        line = F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
        (o.select(file.alias("_f"), "o_orderkey", line.alias("value")).repartition("_f").sortWithinPartitions("_f", "o_orderkey")
          .select("_f", "value").write.mode("overwrite").partitionBy("_f").text(path))
    return staged(spark, sf, "order_lines", write)


@register("ingest_max_ranges", f"""
WITH l AS (SELECT strftime(o_orderdate, '%Y-%m') || '-' || CAST(o_orderkey // 1000000 AS VARCHAR) AS f, o_orderkey, o_custkey, o_orderstatus,
                  strlen(concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus)) + 1 AS b FROM orders),
p AS (SELECT *, coalesce(sum(b) OVER (PARTITION BY f ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ofs FROM l),
s AS (SELECT f, sum(b) AS len FROM l GROUP BY f),
u AS (SELECT greatest(sum(len) // {RANGES_TARGET}, 1) AS unit FROM s),
n AS (SELECT f, len, (len - 1) // unit + 1 AS n FROM s, u),
c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT o_orderkey, o_custkey, o_orderstatus AS status FROM p JOIN c USING (f)
WHERE before < {MAX_RANGES} AND ofs < CASE WHEN before + n <= {MAX_RANGES} THEN len ELSE len * ({MAX_RANGES} - before) // n END""")
def q_ingest_max_ranges(spark, sf):
    opts = IngestOptions(path=f"{_order_lines(spark, sf)}/*", target_ranges=RANGES_TARGET, max_ranges=MAX_RANGES)
    return read_ingest(spark, opts, [D.Col("o_orderkey", "long"), D.Col("o_custkey", "long"), D.Col("status")])


# ---------------------------------------------------------------- spans with gaps, codecs by content

SPAN_DAYS = 12
GAP = 3                                  # days whose number it divides have no folder


def _events_with_gaps(spark, sf):
    def write(path):
        ev = table(spark, sf, "events").where(F.day("ts") % GAP != 0)
        (ev.withColumn("year", F.date_format("ts", "yyyy")).withColumn("day", F.date_format("ts", "MMM-dd")).hint("rebalance", "day")
           .write.mode("overwrite").partitionBy("year", "day").options(**CSV).csv(path))
    return staged(spark, sf, "events_with_gaps", write)


@register("scan_span_gaps", f"""
SELECT * FROM events
WHERE CAST(ts AS DATE) BETWEEN CAST(TIMESTAMP '{TEMPLATE_NOW}' - INTERVAL {SPAN_DAYS} DAY AS DATE) AND CAST(TIMESTAMP '{TEMPLATE_NOW}' AS DATE)
  AND day(ts) % {GAP} <> 0""")
def q_scan_span_gaps(spark, sf):
    import datetime as dt

    now = dt.datetime.fromisoformat(TEMPLATE_NOW)
    paths = SC.existing_paths(spark, f"{_events_with_gaps(spark, sf)}/year=%Y/day=%b-%d", now - dt.timedelta(days=SPAN_DAYS), now)
    return SC.read_csv(spark, paths, EVENTS_SCHEMA, recursive=False, **CSV)


@register("path_times", "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS at FROM events")
def q_path_times(spark, sf):
    # a path of every event, and back
    template = "/in/%Y/%j/%I-%p/%M.%S/x"
    ev = table(spark, sf, "events").select("event_id", templated_path_column(F.col("ts"), template).alias("path"))
    return ev.select("event_id", path_time(F.concat("path", F.lit("/part-0")), template).alias("at"))


@register("strftime_flags", """
SELECT event_id, strftime(ts, '/%-d/%-m/%-y/%-H/%-I/%-M/%-S/%-j/') || upper(strftime(ts, '%a')) || '/' || lpad(CAST(day(ts) AS VARCHAR), 2, ' ')
       || '/' || strftime(ts, '%f') || '/' || strftime(ts, '%g') || '/' || lpad(CAST(year(ts) AS VARCHAR), 6, '0') || strftime(ts, '/%m/%d/%y/')
       || lower(strftime(ts, '%p')) || '/' || strftime(ts, '%G') || '/' || CAST(year(ts) // 100 AS VARCHAR) AS path, ts AS at
FROM events""")
def q_strftime_flags(spark, sf):
    # flags and widths on a column, and the time read back from the path
    template = "/%-d/%-m/%-y/%-H/%-I/%-M/%-S/%-j/%^a/%e/%6N/%3N/%06Y/%D/%P/%G/%C"
    ev = table(spark, sf, "events").select("event_id", templated_path_column(F.col("ts"), template).alias("path"))
    return ev.select("event_id", "path", path_time(F.col("path"), template).alias("at"))


def _customer_any_codec(spark, sf):
    """The customers' lines packed by five codecs into files whose names tell nothing."""
    def write(path):
        import pyarrow as pa

        def packed(i):
            def pack(batches):
                import bz2
                import gzip
                import lzma

                one = (gzip.compress, bz2.compress, lzma.compress, lambda b: b)[i]
                data = [one("".join(f"{v}\n" for v in b.column(0).to_pylist()).encode()) for b in batches if b.num_rows]
                if data:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(data)], pa.binary())], names=["file"])
            return pack

        lines = table(spark, sf, "customer").select("c_custkey", F.to_csv(F.struct(
            "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), {"quote": '"', "escape": '"'}).alias("value"))
        for i in range(4):
            # members of a file follow one another; what stands between rows is padding, or a line end of plain text
            (lines.where(F.col("c_custkey") % 4 == i).select("value").mapInArrow(packed(i), "file binary")
                  .select(F.col("file").cast("string").alias("value")).write.mode("overwrite")
                  .option("lineSep", "\0" if i < 3 else "\n").option("compression", "none").text(f"{path}/{i}"))
    return staged(spark, sf, "customer_any_codec", write)


@register("scan_codec_by_content", "SELECT * FROM customer")
def q_scan_codec_by_content(spark, sf):
    lines = CO.read_by_content(spark, _customer_any_codec(spark, sf)).select(F.col("line").alias("value"))
    cols = [D.Col("c_custkey", "long"), D.Col("c_name"), D.Col("c_nationkey", "int"),
            D.Col("c_acctbal", "double"), D.Col("c_mktsegment")]
    return D.parse_delimited(lines, cols)


MEMBER_BYTES = 16_384                     # of text in a member, whatever lines it cuts


def _orders_members(spark, sf):
    """The orders' lines in gzip files of many members, cut inside lines."""
    def write(path):
        import pyarrow as pa

        def pack(batches):
            import gzip

            rest, done = b"", False
            while not done:
                batch = next(batches, None)
                done = batch is None
                rest += b"" if done else "".join(f"{v}\n" for v in batch.column(0).to_pylist()).encode()
                cuts = range(0, len(rest) if done else len(rest) - MEMBER_BYTES, MEMBER_BYTES)
                data = [gzip.compress(rest[a : a + MEMBER_BYTES], 1, mtime=0) for a in cuts]
                rest = rest[len(data) * MEMBER_BYTES :]
                if data:
                    yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["member"])

        lines = table(spark, sf, "orders").select(F.to_csv(F.struct(*[c.split()[0] for c in ORDERS_SCHEMA.split(", ")]), {
            "quote": '"', "escape": '"'}).alias("value"))
        # a row is a member; zeros between members are padding
        (lines.mapInArrow(pack, "member binary").select(F.col("member").cast("string").alias("value"))
              .write.mode("overwrite").option("lineSep", "\0").option("compression", "none").text(path))
    return staged(spark, sf, "orders_members", write)


@register("scan_gzip_members", "SELECT * FROM orders")
def q_scan_gzip_members(spark, sf):
    lines = ME.read_gzip_members(spark, _orders_members(spark, sf), group_bytes=4 * MEMBER_BYTES).select(F.col("line").alias("value"))
    return lines.select(F.from_csv("value", ORDERS_SCHEMA, {"quote": '"', "escape": '"'}).alias("r")).select("r.*")


WIDE = {"UTF-16LE": 0, "UTF-16BE": 1}      # remainder of the orders' keys in each


def _orders_wide(spark, sf):
    def write(path):
        o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.col("o_orderpriority"), F.lit(" \u0a0a\u0a00")).alias("mark"), "o_totalprice")
        for encoding, rest in WIDE.items():
            o.where(F.col("o_orderkey") % 2 == rest).write.mode("overwrite").option("encoding", encoding).option("header", True).csv(f"{path}/{encoding}")
    return staged(spark, sf, "orders_wide", write)


@register("scan_wide_splits", "SELECT o_orderkey, o_orderpriority || ' ' || chr(2570) || chr(2560) AS mark, o_totalprice FROM orders")
def q_scan_wide_splits(spark, sf):
    # characters whose bytes are a line end's, in files cut inside characters
    cols = [D.Col("o_orderkey", "long"), D.Col("mark"), D.Col("o_totalprice", "double")]
    one, two = (D.read_delimited(spark, f"{_orders_wide(spark, sf)}/{e}", cols, encoding=e, header_lines=1, split_bytes=100_001) for e in WIDE)
    return one.unionByName(two)
