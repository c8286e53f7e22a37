"""Registered queries: one per operator family of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the given tables (whole tables, whole texts).
Edge cases the tables lack (nulls, blanks, padding, control characters, odd number
formats) are made inside the query from existing columns, identically in the
DuckDB oracle (``tessera.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import functions as tf
from tessera.operators import computed, metrics
from tessera.operators.chunk import assign_chunks
from tessera.operators.clean import clean, clean_strings, cleaning_stats, drop_empty_rows, handle_missing, interpolate_missing
from tessera.operators.dedupe import dedupe_first
from tessera.operators.extract import extract_items, extract_targets, next_links, pagination_walk
from tessera.operators.flatten import flatten_json
from tessera.operators.merge import merge_versions
from tessera.operators.search import filter_by_field, newest_first, search
from tessera.operators.transform import (CONV_ERRORS_COL, FunctionRegistry, apply_field_mapping, convert_types,
                                         evaluate_expression, transform, transform_stats, variant_stats)
from tessera.operators.validate import ERRORS_COL, error_counts, validate
from tessera.plans.runner import append_run_log, build_plan, failures, plan_only, run_all_targets, run_outputs, run_target
from tessera.session import read_table, scratch_path, table_path
from tessera.sources.batches import BatchStore
from tessera.sources.csv import count_csv, read_csv, write_csv
from tessera.sources.doctable import DocumentTable
from tessera.sources.jsonl import count_jsonl, read_jsonl, write_jsonl
from tessera.sources.sinks import backup, clear, export, output_path, storage_info, write_sink
from tessera.streaming.incremental import dedupe_run, incremental_run, read_file_stream


def _t(spark, d, name) -> DataFrame:
    return read_table(spark, d, name)


def _failed(c=CONV_ERRORS_COL):
    return F.coalesce(F.size(F.col(c)) > 0, F.lit(False))


# ---------------------------------------------------------------- flagship
def flagship_clean_dedupe_transform(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", "text", "lang", "source")
    spec = {"remove_duplicates": True, "duplicate_keys": ["text"], "clean_before_dedupe": True}
    good, _ = clean(docs, spec, order_by="doc_id")
    out = transform(good, {"field_mapping": {"text": "body"},
                           "custom_functions": {"text_length": computed.text_length("body"),
                                                "word_count": computed.text_word_count("body")}})
    return out.select("doc_id", "body", "lang", "source", "text_length", "word_count")


# ---------------------------------------------------------------- missing values
def _orders_with_gaps(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))


MISSING_RULES = {"o_orderstatus": {"type": "string", "required": True},
                 "o_orderpriority": {"type": "string", "required": True}}


def missing_drop(spark, d):
    return handle_missing(_orders_with_gaps(spark, d), {"strategy": "drop"}, MISSING_RULES)


def missing_default(spark, d):
    m = {"strategy": "default",
         "default_values": {"o_orderstatus": "N/A", "o_orderpriority": "UNKNOWN", "o_clerk": "none"}}
    return handle_missing(_orders_with_gaps(spark, d), m)


def missing_interpolate(spark, d):
    m = {"strategy": "interpolate", "default_values": {"o_orderstatus": "O", "o_orderpriority": "3-MEDIUM"}}
    return handle_missing(_orders_with_gaps(spark, d), m)


def missing_ffill(spark, d):
    """Values carried forward; one key has a third of the rows."""
    e = _t(spark, d, "events").select(
        "event_id", "ts", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id")).alias("key"),
        F.when(F.col("event_type").isin("click", "error"), F.col("value")).alias("value"),
        F.when(F.col("event_type") == "purchase", F.col("event_type")).alias("kind"))
    return interpolate_missing(e, {"value": -1.0, "kind": "none"}, "ffill", ["key"], ["ts", "event_id"]).select(
        "event_id", "key", "value", "kind")


# ---------------------------------------------------------------- de-duplication
def dedupe_first_documents(spark, d):
    docs = _t(spark, d, "documents")
    return dedupe_first(docs, ["text"], "doc_id").select("doc_id", "lang", "source", "n_chars")


def dedupe_events(spark, d):
    ev = _t(spark, d, "events")
    return dedupe_first(ev, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "event_id", "user_id", "event_type", "value")


# ---------------------------------------------------------------- validation
def _orders_for_validation(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    ck = o.o_custkey.cast("string")
    return o.select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(o.o_orderstatus == "P", F.concat(ck, F.lit(".5"))).otherwise(F.concat(F.lit(" "), ck)).alias("custkey_text"),
        F.when((o.o_orderstatus == "F") & (o.o_orderpriority == "1-URGENT"), F.lit("n/a"))
         .otherwise(o.o_totalprice.cast("long").cast("string")).alias("price_text"),
        F.when(o.o_orderstatus == "F", "yes").when(o.o_orderstatus == "O", "no").otherwise("maybe").alias("flag_text"))


VALIDATION_RULES = {
    "o_orderpriority": {"type": "string", "required": True},
    "custkey_text": {"type": "int"},
    "price_text": {"type": "float"},
    "flag_text": {"type": "bool"},
}


def validate_good(spark, d):
    good, _ = validate(_orders_for_validation(spark, d), VALIDATION_RULES)
    return good


def validate_rejected(spark, d):
    _, bad = validate(_orders_for_validation(spark, d), VALIDATION_RULES)
    return bad.select("o_orderkey", F.array_join(ERRORS_COL, ",").alias("errors"))


def validate_error_counts(spark, d):
    return error_counts(_orders_for_validation(spark, d), VALIDATION_RULES)


# ---------------------------------------------------------------- string cleaning
def _padded_parts(spark, d) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select(
        "p_partkey",
        F.concat(F.lit("  "), p.p_name, F.lit("   x "), F.lit("\x01"), F.lit(" ")).alias("name"),
        F.concat(F.lit("\t"), p.p_brand, F.lit("   ")).alias("brand"),
        "p_type", "p_size",
        F.array(F.concat(F.lit(" "), p.p_name, F.lit("  ")),
                F.concat(p.p_type, F.lit("\t"), F.lit(" x  y")), p.p_brand).alias("tags"))


def clean_strings_part(spark, d):
    return clean_strings(_padded_parts(spark, d).drop("tags"))


def clean_string_arrays(spark, d):
    out = clean_strings(_padded_parts(spark, d).select("p_partkey", "tags"))
    return out.select("p_partkey", F.array_join("tags", "|").alias("tags"))


# ---------------------------------------------------------------- statistics
def cleaning_stats_documents(spark, d):
    docs = _t(spark, d, "documents")
    out = cleaning_stats(docs, {"remove_duplicates": True, "duplicate_keys": ["text"]}, "doc_id")
    return out.withColumn("removal_rate", F.round("removal_rate", 6))


def transform_spec() -> dict:
    return {
        "field_mapping": {"text": "body", "source": "origin"},
        "type_conversions": {"n_chars": "string"},
        "custom_functions": {"text_length": computed.text_length("body"),
                             "word_count": computed.text_word_count("body")},
    }


def transform_stats_documents(spark, d):
    docs = _t(spark, d, "documents")
    return transform_stats(docs, transform(docs, transform_spec()))


def transform_stats_variant(spark, d):
    """T13 over records without a schema: each row has other fields."""
    e = _t(spark, d, "events")
    made = lambda name, more: e.select(F.parse_json(F.concat(F.lit('{"'), name, F.lit('":1,"p":'), "props", F.lit(more))).alias("value"))
    return variant_stats(made(F.col("event_type"), "}"), made(F.upper("event_type"), ',"score":null}'))


# ---------------------------------------------------------------- transformation
def field_mapping(spark, d):
    c = _t(spark, d, "customer")
    return apply_field_mapping(c, {"c_name": "name", "c_acctbal": "balance",
                                   "c_mktsegment": "segment", "c_phone": "phone"})


def convert_string(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                                      (F.col("l_returnflag") == "R").alias("is_return"))
    out = convert_types(li, {"l_quantity": "string", "is_return": "string", "l_linenumber": "String"})
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "is_return")


def _numeric_text(li: DataFrame, kind: str) -> DataFrame:
    qs = F.col("l_quantity").cast("long").cast("string")
    n = F.col("l_linenumber")
    if kind == "bool":
        raw = (F.when(n == 1, "true").when(n == 2, "TRUE").when(n == 3, "yes").when(n == 4, " on")
               .when(n == 5, "0").when(n == 6, "no").otherwise(qs))
    else:
        raw = (F.when(n == 1, F.concat(qs, F.lit(".9"))).when(n == 2, F.concat(F.lit("-"), qs, F.lit(".9")))
               .when(n == 3, F.concat(F.lit(" "), qs, F.lit(" "))).when(n == 4, F.concat(qs, F.lit("e1")))
               .when(n == 5, F.lit("inf")).when(n == 6, F.lit(""))
               .otherwise(F.concat(F.lit("1_" if kind == "float" else "x"), qs)))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"))


def _convert_numeric(spark, d, kind):
    li = _numeric_text(_t(spark, d, "lineitem"), kind)
    out = convert_types(li.withColumn("value", F.col("raw")), {"value": kind})
    cols = ["l_orderkey", "l_linenumber", "raw", "value"]
    if kind != "bool":
        return out.select(*cols, _failed().alias("failed"))
    return out.select(*cols)


def convert_int(spark, d):
    return _convert_numeric(spark, d, "int")


def convert_float(spark, d):
    return _convert_numeric(spark, d, "float")


def convert_bool(spark, d):
    return _convert_numeric(spark, d, "bool")


def convert_array(spark, d):
    p = _t(spark, d, "part")
    m = p.p_size % 4
    raw = (F.when(m == 0, F.concat(F.lit('["'), F.replace(p.p_name, F.lit(" "), F.lit('", "')), F.lit('"]')))
           .when(m == 1, F.replace(p.p_name, F.lit(" "), F.lit(", ")))
           .when(m == 2, F.concat(F.lit("["), p.p_name))
           .otherwise(F.concat(F.lit("["), p.p_size.cast("string"), F.lit(", "), p.p_partkey.cast("string"), F.lit("]"))))
    out = convert_types(p.select("p_partkey", raw.alias("raw")).withColumn("items", F.col("raw")),
                        {"items": "array"})
    return out.select("p_partkey", "raw", F.array_join("items", "|").alias("items"),
                      F.size("items").cast("long").alias("n_items"))


def convert_dict(spark, d):
    e = _t(spark, d, "events")
    raw = F.when(e.event_type == "error", F.concat(F.lit("oops "), e.props)).otherwise(e.props)
    out = convert_types(e.select("event_id", raw.alias("props")), {"props": "dict"})
    return out.select("event_id", F.col("props")["k"].alias("k"), _failed().alias("failed"))


def convert_datetime(spark, d):
    o = _t(spark, d, "orders")
    m = o.o_orderkey % 5
    dt = o.o_orderdate
    raw = (F.when(m == 0, tf.format_ntz(dt, "yyyy-MM-dd HH:mm:ss")).when(m == 1, tf.format_ntz(dt, "yyyy-MM-dd"))
           .when(m == 2, tf.format_ntz(dt, "MM/dd/yyyy")).when(m == 3, tf.format_ntz(dt, "dd/MM/yyyy"))
           .otherwise(tf.format_ntz(dt, "d.M.yyyy")))
    out = convert_types(o.select("o_orderkey", raw.alias("raw")).withColumn("parsed", F.col("raw")),
                        {"parsed": "datetime"})
    return out.select("o_orderkey", "raw", tf.format_ntz("parsed", "yyyy-MM-dd HH:mm:ss").alias("parsed"),
                      _failed().alias("failed"))


def computed_columns(spark, d):
    docs = _t(spark, d, "documents")
    fns = {
        "text_length": "text_length",
        "word_count": "word_count",
        "text_hash": "text_hash",
        "keyword_category": "keyword_category",
        "keyword_la": computed.keyword_category("text", "la"),
        "upper_lang": computed.upper_text("lang"),
        "n_chars_x2": computed.times_two("n_chars"),
        "initials": computed.author_initials(F.concat_ws(" ", "lang", "source")),
        "line_count": computed.tag_count(F.split(F.col("text"), "\n")),
    }
    return transform(docs, {"custom_functions": fns}).drop("text")


def computed_columns_pages(spark, d):
    pg = _t(spark, d, "pages")
    price = F.concat(F.lit("$"), pg.page_id.cast("string"), F.lit(","),
                     F.lpad((pg.page_id % 1000).cast("string"), 3, "0"), F.lit(".5"))
    fns = {"url_category": computed.url_category("url"), "domain": computed.domain("url"),
           "price_clean": computed.price_clean(price)}
    return transform(pg.select("page_id", "url"), {"custom_functions": fns})


def eval_expression(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                         "l_returnflag", "l_linestatus")
    out = evaluate_expression(li, "l_quantity * 2 + l_linenumber", "result")
    out = evaluate_expression(out, "l_returnflag || '-' || l_linestatus", "flags")
    return out.select("l_orderkey", "l_linenumber", "result", "flags")


# ---------------------------------------------------------------- column functions
def clean_text_documents(spark, d):
    docs = _t(spark, d, "documents")
    src = F.concat(F.lit("  “"), docs.text, F.lit("” ‘x’\t\t"), F.lit("\x01"))
    return docs.select("doc_id", tf.clean_text(src).alias("cleaned"))


def extract_domain_pages(spark, d):
    pg = _t(spark, d, "pages")
    return pg.select("page_id", tf.extract_domain("url").alias("domain"),
                     tf.extract_domain(F.regexp_replace("url", "^[a-z]+:", "")).alias("domain_relative"),
                     tf.extract_domain(F.regexp_replace("url", "^[a-z]+://", "")).alias("domain_bare"))


MIRROR = "http://mirror.example.org/a/b"


def normalize_url_pages(spark, d):
    pg = _t(spark, d, "pages")
    rel = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    return pg.select("page_id", tf.normalize_url("url").alias("norm"),
                     tf.normalize_url(rel, MIRROR).alias("norm_rel"))


def hashes(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", tf.generate_hash("text", "md5").alias("md5"),
                       tf.generate_hash("text", "sha1").alias("sha1"),
                       tf.generate_hash("text", "sha256").alias("sha256"))


def record_hashes(spark, d):
    """U4: digest of a record as sorted-key JSON, with a null."""
    c = _t(spark, d, "customer").select("c_name", "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), "c_acctbal")
    return c.select("c_custkey", tf.record_hash(c).alias("md5"))


# Spark patterns that print the twelve parse_date formats (fixed, same order)
_DATE_PRINT = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd",
               "MM/dd/yyyy", "dd/MM/yyyy", "MM-dd-yyyy", "dd-MM-yyyy", "MMMM dd, yyyy", "MMM dd, yyyy",
               "dd MMMM yyyy", "dd MMM yyyy"]


def parse_date_orders(spark, d):
    o = _t(spark, d, "orders")
    m = o.o_orderkey % 12
    raw = F.lit(None).cast("string")
    for i, p in enumerate(_DATE_PRINT):
        raw = F.when(m == i, tf.format_ntz(o.o_orderdate, p)).otherwise(raw)
    raw = F.when(o.o_orderkey % 2 == 1, F.concat(F.lit(" "), raw, F.lit(" "))).otherwise(raw)
    # the input is projected once; the parser reads the column (not 12 copies of the expression)
    texts = o.select("o_orderkey", raw.alias("raw"))
    parsed = texts.select("o_orderkey", tf.parse_date("raw").alias("parsed"))
    return parsed.select("o_orderkey", tf.format_ntz("parsed", "yyyy-MM-dd HH:mm:ss").alias("parsed"))


def file_size(spark, d):
    docs = _t(spark, d, "documents")
    size = docs.n_chars * 1000 + docs.doc_id
    return docs.select("doc_id", tf.format_file_size(size).alias("size_text"),
                       tf.format_file_size(docs.n_chars).alias("chars_text"))


def safe_filename_pages(spark, d):
    pg = _t(spark, d, "pages")
    long_name = F.concat(F.repeat(pg.url, 6), F.lit(" .html"))
    return pg.select("page_id", tf.safe_filename("url").alias("fname"),
                     tf.safe_filename(long_name).alias("fname_long"))


def emails(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(tf.extract_emails("text")).alias("pos", "email"))


def phones(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(tf.extract_phone_numbers("text")).alias("pos", "phone"))


def slugify_documents(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", tf.slugify("text").alias("slug"))


def merge_maps(spark, d):
    e = _t(spark, d, "events")
    kv = e.select("user_id", "ts", "event_id",
                  F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return kv.groupBy("user_id", "key").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("value"))


def chunks(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "ts")
    return assign_chunks(e, 5, ["ts", "event_id"], ["user_id"]).select(
        "event_id", "user_id", "chunk_id", "chunk_pos")


def _nested_json(e: DataFrame):
    return F.concat(F.lit('{"u":{"id":'), e.user_id.cast("string"), F.lit(',"t":"'), e.event_type,
                    F.lit('"},"p":'), e.props, F.lit(',"x":['), e.event_id.cast("string"),
                    F.lit(',{"y":'), e.user_id.cast("string"), F.lit('}],"e":{}}'))


def flatten_events(spark, d):
    e = _t(spark, d, "events")
    return flatten_json(e.select("event_id", _nested_json(e).alias("j")), "j", ["event_id"])


def merge_versions_events(spark, d):
    e = _t(spark, d, "events")
    docs = e.select("user_id", "ts", "event_id", _nested_json(e).alias("doc"))
    return merge_versions(docs, ["user_id"], "doc", ["ts", "event_id"])


def flatten_documents(spark, d):
    docs = _t(spark, d, "documents")
    j = F.to_json(F.struct("doc_id", F.struct("text", "lang").alias("body"), F.array(F.struct("source"), F.struct(F.col("lang").alias("source"))).alias("meta"), "n_chars"))
    odd = F.concat(F.lit(r'{"n":2.50,"big":1e400,"half":"\ud800.","\udfffk":[-0],"doc":'), j, F.lit("}"))
    return flatten_json(docs.select("doc_id", odd.alias("j")), "j", ["doc_id"])


def merge_versions_documents(spark, d):
    """Scalars over objects, objects over scalars, empty objects, a dotted key, a tie; and one
    id with a quarter of all versions, each with a place of its own."""
    docs = _t(spark, d, "documents")
    js = F.to_json
    first = js(F.struct(F.struct(F.col("text").alias("t")).alias("a"), F.struct(F.lit(1).alias("y")).alias("x"),
                        F.lit(2).alias("x.y"), F.lit("old").alias("s")))
    versions = [(1, 0, first), (2, 0, F.when(F.col("doc_id") % 3 == 0, js(F.struct(F.col("source").alias("a"), F.lit("first").alias("s"))))),
                (2, 1, F.lit('{"s":"second"}')), (3, 0, F.when(F.col("doc_id") % 2 == 0, F.lit('{"a":{}}')))]
    every = F.array(*[F.struct(F.lit(v).alias("ver"), F.lit(t).alias("tie"), j.alias("doc")) for v, t, j in versions])
    rows = docs.select("doc_id", F.explode(every).alias("e")).select("doc_id", "e.*").where("doc IS NOT NULL")
    own = F.concat(F.lit('{"k'), F.col("doc_id").cast("string"), F.lit('":{"half":"\\ud800"},"n":'), F.col("doc_id").cast("string"), F.lit('.50}'))
    hot = docs.select(F.lit(-1).cast("long").alias("doc_id"), F.col("doc_id").cast("int").alias("ver"), F.lit(0).alias("tie"), own.alias("doc"))
    return merge_versions(rows.unionByName(hot), ["doc_id"], "doc", ["ver", "tie"])


def redact_customer(spark, d):
    c = _t(spark, d, "customer")
    extra = F.create_map(F.lit("api_token"), c.c_name, F.lit("segment"), c.c_mktsegment)
    red = tf.redact(c.withColumn("extra", extra))
    return red.select(*c.columns, F.col("extra")["api_token"].alias("api_token"),
                      F.col("extra")["segment"].alias("segment"))


def redact_json_values(spark, d):
    """U14 in JSON text and VARIANT at any depth, and in a map of structs."""
    e = _t(spark, d, "events")
    text = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "AUTH":'), "props",
                    F.lit(', "l":[{"api_Token" : [1, {"x":"]"}], "n": 1.50}, "token"],"p":{"q":'), "props", F.lit("}}"))
    pair = F.struct("event_type", "user_id")
    rows = e.select("event_id", text.alias("doc"), F.parse_json(text).alias("v"), F.create_map(F.lit("secret"), pair, F.lit("plain"), pair).alias("m"))
    out = tf.redact(rows, json_cols=("doc",))
    got = lambda path: F.variant_get("v", path, "string")
    return out.select("event_id", "doc", got("$.AUTH").alias("auth"), got("$.l[0].api_Token").alias("token"), got("$.p.q.k").alias("k"),
                      *[F.col("m")[m][c].alias(f"{m}_{c}") for m in ("secret", "plain") for c in ("event_type", "user_id")])


# ---------------------------------------------------------------- search (Q1-Q5)
def search_eq(spark, d):
    e = _t(spark, d, "events")
    return search(e, {"event_type": "error", "props": '{"k": 69}'}).select("event_id", "user_id", "event_type", "value")


def search_hot(spark, d):
    """Equality on hot columns of stored items, by sorted files and Bloom filters."""
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    hot = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("user_id", T.LongType())])
    t = DocumentTable(spark, scratch_path(spark, "events_hot"), hot)
    t.save(e, target_name="events")
    return t.load(e.schema, where={"event_type": "error", "user_id": 69}).select(*e.columns)


def filter_field(spark, d):
    return filter_by_field(_t(spark, d, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_totalprice")


def newest_topk(spark, d):
    e = _t(spark, d, "events")
    return newest_first(e, "ts", "event_id", limit=10).select(
        "event_id", tf.format_ntz("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


ORDER_DOC_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                                 T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
                                 T.StructField("o_orderdate", T.TimestampNTZType()),
                                 T.StructField("o_orderpriority", T.StringType())])


def _orders_table(spark, d) -> str:
    o = _t(spark, d, "orders")
    path = scratch_path(spark, "orders_doc")
    DocumentTable(spark, path).save(o.withColumn("target_name", F.col("o_orderpriority")), run_id="r1")
    return path


def target_filter(spark, d):
    path = _orders_table(spark, d)
    df = DocumentTable(spark, path).load(ORDER_DOC_SCHEMA, target_name="2-HIGH")
    return df.select("o_orderkey", "o_totalprice", "target_name")


# ---------------------------------------------------------------- sources and sinks
def csv_roundtrip(spark, d):
    c = _t(spark, d, "customer")
    path = write_csv(c, scratch_path(spark, "customer_csv"))
    write_csv(c.withColumn("c_name", F.concat("c_name", F.lit('\r\n"x",\n'))), path, mode="append")
    return read_csv(spark, path)


def jsonl_roundtrip(spark, d):
    conv = _t(spark, d, "conversations")
    path = write_jsonl(conv, scratch_path(spark, "conversations_jsonl"))
    return read_jsonl(spark, path, conv.schema)


def jsonl_ascii_roundtrip(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    path = write_jsonl(docs, scratch_path(spark, "documents_ascii"), ensure_ascii=True)
    return read_jsonl(spark, path, docs.schema)


def table_roundtrip(spark, d):
    c = _t(spark, d, "customer")
    path = scratch_path(spark, "customer_table")
    DocumentTable(spark, path).save(c.withColumn("target_name", F.col("c_mktsegment")), run_id="r1")
    return DocumentTable(spark, path).load(c.schema).drop("_id", "created_at")


def export_target(spark, d):
    path = _orders_table(spark, d)
    out = export(spark, path, "jsonl", scratch_path(spark, "export_jsonl"), ORDER_DOC_SCHEMA, target="1-URGENT")
    back = read_jsonl(spark, out, T.StructType(ORDER_DOC_SCHEMA.fields + [T.StructField("run_id", T.StringType()),
                                                                          T.StructField("target_name", T.StringType())]))
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                       tf.format_ntz("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
                       "o_orderpriority", "run_id", "target_name")


def backup_convert(spark, d):
    p = _t(spark, d, "part")
    tpath = scratch_path(spark, "part_table")
    DocumentTable(spark, tpath).save(p, run_id="r1", target_name="parts")
    loaded = DocumentTable(spark, tpath).load(p.schema).select(*p.columns)
    loaded = loaded.withColumn("p_type", F.regexp_replace("p_type", " ", "\r\n"))
    out = backup(loaded, scratch_path(spark, "part_backup") + ".csv")
    return read_csv(spark, out)


def csv_append_union(spark, d):
    """Files of other columns appended to a CSV folder."""
    c = _t(spark, d, "customer")
    path = write_csv(c.select("c_custkey", "c_name"), scratch_path(spark, "union_csv"))
    write_csv(c.select(F.lit("x").alias("a"), "c_custkey", (F.col("c_acctbal") * 1e6).alias("c_big")), path, mode="append")
    write_csv(c.select("c_custkey", F.concat("c_name", F.lit("\n"), "c_mktsegment").alias("c_name")), path, mode="append")
    return read_csv(spark, path).select("a", F.round(F.col("c_big").cast("double"), 2).alias("c_big"), "c_custkey", "c_name",
                                        F.length("c_big").alias("digits"))


def csv_dialect(spark, d):
    """Another delimiter, minimal quoting, cells that hold the delimiter and quotes."""
    o = _t(spark, d, "orders").select("o_orderkey", F.concat(F.lit('a;"b"; '), "o_orderpriority").alias("note"))
    return read_csv(spark, write_csv(o, scratch_path(spark, "dialect_csv"), delimiter=";", quote_all=False), delimiter=";")


def table_own_id(spark, d):
    """An item's own id comes back."""
    c = _t(spark, d, "customer").select((F.col("c_custkey") * 3).alias("id"), "c_name")
    t = DocumentTable(spark, scratch_path(spark, "own_id"))
    t.save(c, target_name="t")
    return t.load(c.schema).select("id", "c_name", "target_name")


def table_bad_json(spark, d):
    """Rows whose JSON is cut off are counted, and skipped when read."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    t = DocumentTable(spark, scratch_path(spark, "bad_json"))
    t.save(c, target_name="t", batch_key="b")
    cut = F.when(F.get_json_object("data", "$.c_custkey").cast("long") % 4 == 0, F.expr("substring(data, 1, length(data) - 3)")).otherwise(F.col("data"))
    rows, t = t.table().withColumn("data", cut), DocumentTable(spark, scratch_path(spark, "bad_json_cut"))
    t.restore(rows)
    return t.load(c.schema).select("c_custkey", "c_name").withColumn("stored", F.lit(t.count()).cast("long"))


def counts_and_clear(spark, d):
    """Records (with line breaks) counted by kind of sink, and after clearing."""
    c, out = _t(spark, d, "customer").withColumn("c_name", F.concat("c_name", F.lit("\nx\r"))), []
    for kind in ("csv", "jsonl", "table"):
        path = write_sink(c, kind, scratch_path(spark, f"count_{kind}"))
        count = {"csv": count_csv, "jsonl": count_jsonl, "table": lambda s, p: DocumentTable(s, p).count()}[kind]
        n = count(spark, path)
        clear(spark, path, kind, c.schema)
        out.append((kind, n, count(spark, path)))
    new = DocumentTable(spark, scratch_path(spark, "new_table"))
    new.create_if_absent()
    out.append(("new table", int(new.exists()), new.count()))
    return spark.createDataFrame(out, "kind string, stored long, after_clear long")


def output_names(spark, d):
    """A path for each market segment's output."""
    import datetime as dt
    when = dt.datetime(2024, 5, 6, 7, 8, 9)
    named = lambda c: F.regexp_replace(F.lit(output_path("out", "TARGET", "csv", when, "r1")), "TARGET", c)
    return _t(spark, d, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).withColumn("path", named(F.col("c_mktsegment")))


def drop_empty(spark, d):
    """Rows without any value go."""
    o = _t(spark, d, "orders").select(*[F.when(F.col("o_orderkey") % 3 > 0, F.col(c)).alias(c) for c in ("o_orderkey", "o_totalprice")])
    return drop_empty_rows(o).select("o_orderkey", "o_totalprice")


def cleaning_stats_cleaned(spark, d):
    """C12 under cleaning before the dedupe, as the flagship does it, over whole texts
    between blanks that vary."""
    docs = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("  "), "text", F.repeat(F.lit(" "), (F.col("doc_id") % 3).cast("int"))).alias("t"))
    out = cleaning_stats(docs, {"remove_duplicates": True, "duplicate_keys": ["t"], "clean_before_dedupe": True}, "doc_id")
    return out.withColumn("removal_rate", F.round("removal_rate", 6))


def convert_large_and_unknown(spark, d):
    """Numbers of ten million and more as Python prints them; an unknown type changes nothing."""
    o = _t(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") * 1e7 + 0.5).alias("big"), F.col("o_orderstatus").alias("same"))
    return convert_types(o, {"big": "string", "same": "decimal128"}).select("o_orderkey", "big", "same")


def convert_json_whole(spark, d):
    """A text must be one JSON value."""
    e = _t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("[1],["), F.col("user_id").cast("string"), F.lit("]")))
                                      .otherwise(F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit("]"))).alias("a"),
                                      F.when(F.col("event_id") % 2 == 0, F.concat("props", F.lit(" "), "props")).otherwise(F.col("props")).alias("p"))
    out = convert_types(e, {"a": "array", "p": "dict"})
    return out.select("event_id", F.array_join("a", "|").alias("a"), F.col("p")["k"].alias("k"), _failed().alias("failed"))


def null_on_error(spark, d):
    """An expression that fails is null in that row."""
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    out = evaluate_expression(li, "(l_orderkey + 1) / (l_linenumber - 2)", "ratio")
    return transform(out, {"custom_functions": {"as_int": "cast(l_returnflag AS int)", "third": "element_at(array(1, 2), l_linenumber)"}}).select(
        "l_orderkey", "l_linenumber", F.round("ratio", 6).alias("ratio"), "as_int", "third")


def registry_functions(spark, d):
    """Functions added by name, one of them removed again."""
    reg = FunctionRegistry({"twice": "n_chars * 2"})
    reg.add("tail", "substring(text, -3, 3)")
    reg.add("gone", "doc_id")
    reg.remove("gone")
    return transform(_t(spark, d, "documents").select("doc_id", "text", "n_chars"), {}, reg).drop("text")


class _Sentences:
    """A row generator: number and length of what lies between full stops."""

    def eval(self, text: str):
        for i, part in enumerate((text or "").split(". ")):
            yield i, len(part)


def registry_generators(spark, d):
    """A row generator and an Arrow function, registered by name and used in a spec."""
    FunctionRegistry.register_generator(spark, "sentences_of", _Sentences, "pos int, n int")
    FunctionRegistry.register_pandas_udf(spark, "twice_of", lambda s: s * 2, "int")
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return transform(docs, {"row_generators": ["sentences_of(text)"], "custom_functions": {"twice": "twice_of(n)"}}).drop("text")


def bad_urls(spark, d):
    """Invalid authorities and references of many shapes."""
    pg = _t(spark, d, "pages")
    m = pg.page_id % 6
    n = pg.page_id.cast("string")
    u = (F.when(m == 0, F.concat(F.lit("//[x"), n)).when(m == 1, F.concat(F.lit("../"), n)).when(m == 2, F.concat(F.lit("?q="), n))
         .when(m == 3, F.concat(F.lit("./a//b/../"), n)).when(m == 4, F.concat(F.lit("//other.example/"), n)).otherwise(F.concat(F.lit("/r/"), n)))
    return pg.select("page_id", tf.extract_domain(u).alias("domain"), tf.normalize_url(u, "https://base.example/x/y/z?k=1").alias("norm"))


def scrape_counters(spark, d):
    """A1-A4: items scraped, saved, processed and failed by label."""
    log = _log(spark, d)
    by = lambda value, name: metrics.counter(log, ["event_type"], value, name)
    out = by(None, "scraped")
    for value, name in (((F.col("event_type") == "purchase").cast("long"), "saved"), (F.col("ok").cast("long"), "processed"),
                        ((~F.col("ok")).cast("long"), "failed")):
        out = out.join(by(value, name), "event_type")
    return out


def active_runs(spark, d):
    """Runs begun and not ended, by user as run."""
    e = _t(spark, d, "events")
    return metrics.active_runs(e, F.col("event_type") == "click", F.col("event_type") == "purchase", "user_id")


def _course(spark, d) -> DataFrame:
    e = _t(spark, d, "events")
    kind = lambda k: (F.col("event_type") == k).cast("long")
    return metrics.gauge_course(e, "ts", {"active": kind("click") - kind("purchase"), "queue": kind("signup") - kind("click")})


def gauge_course(spark, d):
    """Running jobs and the queue whenever they change."""
    return _course(spark, d).select(tf.format_ntz("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "active", "queue")


def gauge_peaks(spark, d):
    """The peak of each gauge, and when it was reached."""
    return metrics.gauge_peaks(_course(spark, d), "ts").withColumn("peak_at", tf.format_ntz("peak_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def processed_at(spark, d):
    """T11i: the time is the run's; its presence is what can be compared."""
    docs = _t(spark, d, "documents").select("doc_id")
    return transform(docs, {"custom_functions": {"at": "processed_at"}}).select("doc_id", F.col("at").isNotNull().alias("has_time"))


def storage_info_customer(spark, d):
    """Files, and bytes without the files' headers."""
    c = _t(spark, d, "customer")
    path = write_csv(c, scratch_path(spark, "customer_info"))
    n, header = count_csv(spark, path), len(",".join(f'"{x}"' for x in c.columns)) + 1
    files = spark.read.text(path).select(F.input_file_name()).distinct().count()
    return storage_info(spark, path, "customer_csv").select(
        "storage", "exists", (F.col("files") - files).alias("files_unknown"),
        (F.col("size_bytes") - F.col("files") * header).alias("data_bytes"), F.lit(n).cast("long").alias("row_count"))


# ---------------------------------------------------------------- HTML extraction
SITE = "http://site.example/p/"


def _chained(spark, d) -> DataFrame:
    """Pages under chained addresses: the first link of a page leads to the next id, that of
    every fiftieth 20 pages back."""
    pg = _t(spark, d, "pages")
    link = lambda e: F.concat(F.lit(SITE), e.cast("string"))
    on = F.when(pg.page_id % 50 == 49, pg.page_id - 20).otherwise(pg.page_id + 1)
    return pg.select("page_id", link(pg.page_id).alias("url"),
                     F.concat(F.lit('<nav><a class="next" href="'), link(on), F.lit('">on</a></nav>'), pg.html).alias("html"))


def pagination_chain(spark, d):
    """Every page, walked from those that no page links to; the chains end in cycles."""
    pg = _chained(spark, d)
    linked = next_links(pg, "a.next::attr(href)", keep=()).select(F.col("next_url").alias("url"))
    starts = pg.select("url").join(linked, "url", "left_anti")
    return pagination_walk(pg, starts, "a.next::attr(href)", max_pages=1_000_000)


def extract_plain_selector(spark, d):
    """A selector without suffix is the element's text."""
    return extract_items(_chained(spark, d), "nav", {"text": "a.next", "self": "a.next::text"}).where("text = 'on'").select(
        "page_id", "item_pos", "text", "self")


RECORD_SPEC = {
    "name": "records",
    "extract": {"item_selector": "div.rec", "fields": {"num": "b::text", "link": "a::attr(href)", "own": "::attr(data-n)"}},
    "cleaner": {"field_validation": {"num": {"type": "int", "required": True}}},
    "transformer": {"type_conversions": {"num": "int"}, "custom_functions": {"ratio": "12 / (num - 3)"}},
}


def _record_pages(spark, d) -> DataFrame:
    """Pages with one record in front: a number, or n/a in every fifth; an address, or
    an invalid one in every seventh."""
    pg = _t(spark, d, "pages")
    num = F.when(pg.page_id % 5 == 0, F.lit("n/a")).otherwise(pg.page_id.cast("string"))
    href = F.when(pg.page_id % 7 == 0, F.lit("//[x")).otherwise(F.concat(F.lit("r/"), pg.page_id.cast("string")))
    html = F.concat(F.lit('<div class="rec" data-n="d'), pg.page_id.cast("string"), F.lit('"><b>'), num, F.lit('</b><a href="'), href,
                    F.lit('">x</a></div>'), pg.html)
    return pg.select("page_id", F.lit("http://h.example/a/b").alias("url"), html.alias("html"))


def run_result(spark, d):
    out = plan_only(_record_pages(spark, d), {**RECORD_SPEC, "transformer": {
        "type_conversions": {"num": "int"}, "custom_functions": {"ratio": "12 / (num - 3)", "as_int": "cast(link AS int)"}}})
    return out.select("page_id", "item_pos", "num", "link", "own", "ratio", "as_int")


def run_rejected(spark, d):
    """Rejected rows and failed items of a run."""
    _, rejected, errors = build_plan(_record_pages(spark, d), {**RECORD_SPEC, "transformer": {}}, "r")
    return failures(rejected, errors, "records").select("target_name", "page_id", "item_pos", "stage", "reason")


def _two_targets(spark, d):
    heads = {"name": "heads", "extract": {"item_selector": "html", "fields": {"title": "h1::text"}}}
    wrong = {"name": "wrong", "extract": {"fields": {}}}
    return run_all_targets(_record_pages(spark, d), [{**RECORD_SPEC, "transformer": {}}, heads, wrong])


def run_all_targets_results(spark, d):
    return _two_targets(spark, d)[0].select("target_name", "page_id", "item_pos", "num", "title")


def run_all_targets_failures(spark, d):
    return _two_targets(spark, d)[1].groupBy("target_name", "stage").agg(F.count(F.lit(1)).alias("n"))


def run_record(spark, d):
    """Two runs append to one CSV; the log has a row for each, and for a noop run."""
    path, log = scratch_path(spark, "run_csv"), scratch_path(spark, "run_log")
    spec = {**RECORD_SPEC, "transformer": {}, "storage": {"type": "csv", "path": path, "delimiter": ";"}}
    pages = _record_pages(spark, d)
    records = [run_target(pages, spec, run_id=f"r{i}")[1] for i in (1, 2)]
    records.append(run_target(pages, {**spec, "storage": {"type": "noop"}}, run_id="r3")[1])
    append_run_log(spark, records, log)
    stored = read_csv(spark, path, delimiter=";").groupBy("run_id").agg(F.count(F.lit(1)).alias("stored"))
    return spark.read.parquet(log).join(stored, "run_id", "left").select(
        "run_id", "target_name", "status", "scraped_count", "failed_count", "processed_count", "saved_count",
        F.coalesce("stored", F.lit(0)).alias("stored"))


class _Interrupted(BatchStore):
    """A store that fails between two writes of a batch."""

    def commit(self, key, outputs):
        def fails(_):
            raise IOError("interrupted")
        return super().commit(key, {**outputs, "run_log": fails})


def run_outputs_stored(spark, d):
    """Results, rejects, errors and log rows of all targets in one commit. The
    first run fails between its writes and is given again, twice; a second run follows."""
    path = scratch_path(spark, "run_outputs")
    heads = {"name": "heads", "extract": {"item_selector": "html", "fields": {"title": "h1::text"}}}
    specs = [{**RECORD_SPEC, "transformer": {}}, heads, {"name": "wrong", "extract": {"fields": {}}}]
    pages, store = _record_pages(spark, d), BatchStore(spark, path)
    for run, to in (("r1", _Interrupted(spark, path)), ("r1", store), ("r1", store), ("r2", store)):
        try:
            run_outputs(pages, specs, to, run)
        except IOError:
            pass
    out = store.read("run_log").select("run_id", "target_name", F.explode(F.create_map(*[x for c in ("scraped", "failed", "processed", "saved") for x in (
        F.lit(f"log: {c}"), F.col(f"{c}_count"))])).alias("output", "n"))
    for key in ("r1", "r2"):
        for name in ("results", "rejected", "errors"):
            out = out.unionByName(store.read(name, key).groupBy("target_name").agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(key).alias("run_id"), "target_name", F.lit(name).alias("output"), "n"))
    return out


def extract_title(spark, d):
    pg = _t(spark, d, "pages")
    return extract_items(pg, "html", {"title": "h1::text"}).select("page_id", "title")


def extract_nav_links(spark, d):
    pg = _t(spark, d, "pages")
    return extract_items(pg, "nav li", {"text": "a::text", "href": "a::attr(href)"}).select(
        "page_id", "item_pos", "text", "href")


def next_link(spark, d):
    pg = _t(spark, d, "pages")
    return next_links(pg, "nav li a::attr(href)").select("page_id", "next_url")


def pagination_walk_pages(spark, d):
    pg = _t(spark, d, "pages")
    return pagination_walk(pg, pg.select("url"), "nav li a::attr(href)", max_pages=3)


def multi_target_extract(spark, d):
    pg = _t(spark, d, "pages")
    both = extract_targets(pg, {"titles": {"item_selector": "html", "fields": {"title": "h1::text"}},
                                "ads": {"item_selector": "div.ad", "fields": {"ad_text": "::text"}}})
    return both.select("target_name", "page_id", "item_pos", "title", "ad_text")


# ---------------------------------------------------------------- metrics
def _log(spark, d) -> DataFrame:
    """events as a run log: event_type = operation, value = seconds, error = failed."""
    e = _t(spark, d, "events")
    return e.withColumns({"run_day": tf.format_ntz("ts", "yyyy-MM-dd"),
                          "ok": F.col("event_type") != "error"})


def items_by_label(spark, d):
    log = _log(spark, d)
    return log.groupBy("event_type", "run_day").agg(
        F.count(F.lit(1)).cast("long").alias("items"), F.round(F.sum("value"), 4).alias("value_sum"))


def requests_by_status(spark, d):
    log = _log(spark, d)
    return metrics.requests_by_status(log, "user_id", F.when(F.col("ok"), "success").otherwise("error"))


def duration_histogram(spark, d):
    out = metrics.duration_histogram(_log(spark, d), ["event_type"], "value")
    return out.withColumn("duration_sum", F.round("duration_sum", 4))


def last_run(spark, d):
    out = metrics.last_values(_log(spark, d), ["user_id"], "ts", "event_type", F.col("ok"), ("event_id",))
    return out.select("user_id", "last_value",
                      tf.format_ntz("last_attempt", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_attempt"),
                      tf.format_ntz("last_success", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_success"))


def run_summary(spark, d):
    log = _log(spark, d)
    out = metrics.run_summary(log, F.col("ok"), (F.col("event_type") == "purchase").cast("long"), "value")
    return out.withColumns({c: F.round(c, 4) for c in ("total_duration", "avg_duration")})


def job_counts(spark, d):
    return metrics.job_counts(_log(spark, d), F.col("ok"))


def check_suite(spark, d):
    o = _t(spark, d, "orders")
    checks = {
        "orderkey_not_null": F.count_if(F.col("o_orderkey").isNull()),
        "totalprice_non_negative": F.count_if(F.col("o_totalprice") < 0),
        "status_domain": F.count_if(~F.col("o_orderstatus").isin("F", "O", "P")),
        "orderkey_unique": F.count(F.lit(1)) - F.count_distinct("o_orderkey"),
        "no_low_priority": F.count_if(F.col("o_orderpriority") == "5-LOW"),
    }
    return metrics.check_suite(o, checks)


def storage_health(spark, d):
    there = metrics.storage_health(lambda: _t(spark, d, "customer"), spark, "customer")
    gone = metrics.storage_health(lambda: _t(spark, d, "no_such_table"), spark, "no_such_table")
    return there.unionByName(gone).drop("error")


def quality_report(spark, d):
    return metrics.quality_report(_t(spark, d, "documents"))


# ---------------------------------------------------------------- run of a target
def nav_spec() -> dict:
    return {
        "name": "nav",
        "extract": {"item_selector": "nav li", "fields": {"text": "a::text", "href": "a::attr(href)"}},
        "cleaner": {"remove_duplicates": True, "duplicate_keys": ["href"],
                    "handle_missing": {"strategy": "default", "default_values": {"text": "N/A"}}},
        "transformer": {"field_mapping": {"href": "link"},
                        "custom_functions": {"domain": computed.domain("link"),
                                             "text_length": computed.text_length("text")}},
    }


def run_target_dry(spark, d):
    out = plan_only(_t(spark, d, "pages"), nav_spec(), run_id="dry")
    return out.select("page_id", "item_pos", "text", "link", "domain", "text_length", "run_id", "target_name")


# ---------------------------------------------------------------- streaming
def _events_stream(spark, d):
    path = table_path(d, "events")
    return read_file_stream(spark, path, _t(spark, d, "events").schema)


def _stream_fn(df):
    df = clean_strings(df)
    return df.select("event_id", "user_id", F.upper("event_type").alias("kind"),
                     (F.col("value") * 2).alias("value_x2"))


def stream_incremental(spark, d):
    out = scratch_path(spark, "stream_out")
    incremental_run(_events_stream(spark, d), _stream_fn, out, scratch_path(spark, "stream_ckpt"))
    return spark.read.parquet(out)


def stream_dedupe_events(spark, d):
    out = scratch_path(spark, "stream_dedupe_out")
    dedupe_run(_events_stream(spark, d), ["user_id", "event_type"], ["ts", "event_id"], out, scratch_path(spark, "stream_dedupe_ckpt"))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


QUERIES = {
    "flagship_clean_dedupe_transform": flagship_clean_dedupe_transform,
    "missing_drop": missing_drop,
    "missing_default": missing_default,
    "missing_interpolate": missing_interpolate,
    "missing_ffill": missing_ffill,
    "dedupe_first": dedupe_first_documents,
    "dedupe_events": dedupe_events,
    "validate_good": validate_good,
    "validate_rejected": validate_rejected,
    "validate_error_counts": validate_error_counts,
    "clean_strings": clean_strings_part,
    "clean_string_arrays": clean_string_arrays,
    "cleaning_stats": cleaning_stats_documents,
    "transform_stats": transform_stats_documents,
    "transform_stats_variant": transform_stats_variant,
    "field_mapping": field_mapping,
    "convert_string": convert_string,
    "convert_int": convert_int,
    "convert_float": convert_float,
    "convert_bool": convert_bool,
    "convert_array": convert_array,
    "convert_dict": convert_dict,
    "convert_datetime": convert_datetime,
    "computed_columns": computed_columns,
    "computed_columns_pages": computed_columns_pages,
    "eval_expression": eval_expression,
    "clean_text": clean_text_documents,
    "extract_domain": extract_domain_pages,
    "normalize_url": normalize_url_pages,
    "hashes": hashes,
    "record_hashes": record_hashes,
    "parse_date": parse_date_orders,
    "file_size": file_size,
    "safe_filename": safe_filename_pages,
    "emails": emails,
    "phones": phones,
    "slugify": slugify_documents,
    "merge_maps": merge_maps,
    "chunks": chunks,
    "flatten_json": flatten_events,
    "merge_versions": merge_versions_events,
    "flatten_documents": flatten_documents,
    "merge_versions_documents": merge_versions_documents,
    "redact": redact_customer,
    "redact_json": redact_json_values,
    "pagination_chain": pagination_chain,
    "extract_plain_selector": extract_plain_selector,
    "run_result": run_result,
    "run_rejected": run_rejected,
    "run_all_targets": run_all_targets_results,
    "run_all_failures": run_all_targets_failures,
    "run_record": run_record,
    "run_outputs": run_outputs_stored,
    "csv_append_union": csv_append_union,
    "csv_dialect": csv_dialect,
    "table_own_id": table_own_id,
    "table_bad_json": table_bad_json,
    "counts_and_clear": counts_and_clear,
    "output_names": output_names,
    "drop_empty": drop_empty,
    "cleaning_stats_cleaned": cleaning_stats_cleaned,
    "convert_large_and_unknown": convert_large_and_unknown,
    "convert_json_whole": convert_json_whole,
    "null_on_error": null_on_error,
    "registry_functions": registry_functions,
    "registry_generators": registry_generators,
    "bad_urls": bad_urls,
    "scrape_counters": scrape_counters,
    "active_runs": active_runs,
    "gauge_course": gauge_course,
    "gauge_peaks": gauge_peaks,
    "processed_at": processed_at,
    "search_eq": search_eq,
    "search_hot": search_hot,
    "filter_field": filter_field,
    "newest_topk": newest_topk,
    "target_filter": target_filter,
    "csv_roundtrip": csv_roundtrip,
    "jsonl_roundtrip": jsonl_roundtrip,
    "jsonl_ascii_roundtrip": jsonl_ascii_roundtrip,
    "table_roundtrip": table_roundtrip,
    "export_target": export_target,
    "backup_convert": backup_convert,
    "storage_info": storage_info_customer,
    "extract_title": extract_title,
    "extract_nav_links": extract_nav_links,
    "next_link": next_link,
    "pagination_walk": pagination_walk_pages,
    "multi_target_extract": multi_target_extract,
    "items_by_label": items_by_label,
    "requests_by_status": requests_by_status,
    "duration_histogram": duration_histogram,
    "last_run": last_run,
    "run_summary": run_summary,
    "job_counts": job_counts,
    "check_suite": check_suite,
    "storage_health": storage_health,
    "quality_report": quality_report,
    "run_target_dry": run_target_dry,
    "stream_incremental": stream_incremental,
    "stream_dedupe": stream_dedupe_events,
}
