"""Registered queries of the record-curation operators over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.functions import exact as EX
from sievework.functions import expressions as E
from sievework.functions import text as X
from sievework.operators import answers as AN
from sievework.operators import control as K
from sievework.operators import checks as Q
from sievework.operators import jobs as J
from sievework.operators import records as R
from sievework.operators import reports as RP
from sievework.operators import validators as V
from sievework.plans import plan as P
from sievework.plans.flagship import FLAGSHIP_SQL, gated_curation
from sievework.sources import jsonl as S
from sievework.streaming import control as ST

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None, name: str | None = None):
    def keep(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- fixtures: derived frames and the same in SQL --------------------------------------------------------------------

def labelled(spark, sf):
    return t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left")


LABELLED = "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"


def pairs(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "text")
    i = F.col("doc_id").cast("string")
    src = F.concat("text", F.lit(" See https://ex.org/p"), i, F.lit("?q=1, mail a"), i, F.lit("@ex.org. 1,000.5 and "), i, F.lit(" of 3 000; "), i)
    k = F.col("doc_id") % 5
    tgt = F.when(k == 1, F.regexp_replace("source_text", "[0-9]", "")).when(k == 2, F.concat("source_text", F.lit(" слово"))).when(k == 3, F.expr("left(source_text, cast(length(source_text) div 2 as int))")).when(k == 4, F.concat("source_text", F.repeat(F.lit(" one two three"), 9))).otherwise(F.col("source_text"))
    return d.withColumn("source_text", src).withColumn("target_text", tgt).drop("text")


PAIRS = """(SELECT doc_id, lang, source_text, CASE doc_id % 5 WHEN 1 THEN regexp_replace(source_text, '[0-9]', '', 'g') WHEN 2 THEN source_text || ' слово' WHEN 3 THEN left(source_text, length(source_text) // 2) WHEN 4 THEN source_text || repeat(' one two three', 9) ELSE source_text END AS target_text
FROM (SELECT doc_id, lang, text || ' See https://ex.org/p' || doc_id || '?q=1, mail a' || doc_id || '@ex.org. 1,000.5 and ' || doc_id || ' of 3 000; ' || doc_id AS source_text FROM documents))"""


def done_events(spark, sf):
    e = t(spark, sf, "events")
    return e.select("event_id", "ts", F.concat(F.lit("j"), F.col("user_id") % 5).alias("job"), (F.col("event_id") % 4).cast("int").alias("stage"), F.lpad(((F.col("event_id") * 7 + F.col("user_id")) % 300).cast("string"), 6, "0").alias("chunk_id"), "event_type", (F.col("event_type") == "error").alias("flagged"), F.concat(F.lit("w"), F.col("user_id") % 10).alias("worker_id"), "value")


DONE = "(SELECT event_id, ts, 'j' || (user_id % 5) AS job, (event_id % 4)::INT AS stage, lpad(((event_id * 7 + user_id) % 300)::VARCHAR, 6, '0') AS chunk_id, event_type, event_type = 'error' AS flagged, 'w' || (user_id % 10) AS worker_id, value FROM events)"


def segments(spark, sf):
    c = t(spark, sf, "conversations").where("text is not null")
    item = F.struct(F.concat(F.lit("S"), F.col("turn").cast("string")).alias("id"), F.col("text"), F.replace("text", F.lit("e"), F.lit("E")).alias("translation"), F.col("turn"))
    s = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", item.alias("x")))).alias("s"))
    return s.select("conv_id", F.transform("s", lambda y: F.struct(y.x.id.alias("id"), y.x.text.alias("text"), y.x.translation.alias("translation"))).alias("segments"))


# --- sources and set operations --------------------------------------------------------------------------------------

@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_jsonl(spark, sf):
    """Round trip through the sharded JSON lines sink and scan."""
    path = S.scratch(spark, "scan_jsonl")
    S.write_shards(t(spark, sf, "documents"), path)
    return S.scan(spark, path, schema="doc_id long, text string, lang string, source string, n_chars long")


@query("SELECT doc_id AS id, lang AS tag, NULL::VARCHAR AS role FROM documents UNION ALL SELECT conv_id, NULL, role FROM conversations")
def scan_union(spark, sf):
    a = t(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("tag"))
    return a.unionByName(t(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "role"), allowMissingColumns=True)


@query("SELECT 'https://x/' || lang || '/' || source AS prefix, count(*) AS n FROM documents GROUP BY 1")
def prefix_counts(spark, sf):
    d = t(spark, sf, "documents").select(F.concat(F.lit("https://x/"), "lang", F.lit("/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jsonl")).alias("key"))
    return S.prefix_counts(d, "key")


@query(f"""WITH k AS (SELECT doc_id, unnest(ks) AS key, unnest(range(len(ks))) AS p FROM (SELECT doc_id, list_filter([CASE WHEN doc_id % 3 = 0 THEN 'lang' END, CASE WHEN quality IS NOT NULL THEN 'quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, source], lambda x: x IS NOT NULL) AS ks FROM {LABELLED})),
f AS (SELECT key, min(doc_id * 10 + p) AS o FROM k GROUP BY 1)
SELECT key, row_number() OVER (ORDER BY o) - 1 AS place FROM f""")
def collect_keys(spark, sf):
    """Objects whose keys differ by row; a source's name is a key too."""
    when = lambda c, k, v: F.when(c, F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")))
    pairs_ = F.array(when(F.col("doc_id") % 3 == 0, "lang", F.col("lang")), when(F.col("quality").isNotNull(), "quality", F.col("quality")), when(F.col("toxic") == 1, "toxic", F.col("toxic")), F.struct(F.col("source").alias("key"), F.col("lang").alias("value")))
    d = labelled(spark, sf).select("doc_id", F.to_json(F.map_from_entries(F.filter(pairs_, lambda x: x.isNotNull()))).alias("j"))
    return S.collect_keys(d, "j", "doc_id")


@query("SELECT doc_id, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang, n_chars % 50 ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedup_first(spark, sf):
    d = t(spark, sf, "documents").withColumn("k", F.col("n_chars") % 50)
    return X.first_by(d, ["lang", "k"], ["doc_id"]).select("doc_id", "lang", "n_chars")


# --- filters ---------------------------------------------------------------------------------------------------------

@query(f"SELECT doc_id FROM {LABELLED} WHERE coalesce(quality = 1, false) OR n_chars > 500")
def filter_expr(spark, sf):
    return E.filter_by(labelled(spark, sf), "quality == 1 or n_chars > 500").select("doc_id")


@query(f"SELECT doc_id FROM {LABELLED} WHERE lang IN ('en', 'de') AND quality IS DISTINCT FROM 0 AND n_chars % 7 - 3 > 0")
def filter_and(spark, sf):
    return E.filter_by(E.filter_by(labelled(spark, sf), "lang in ['en', 'de'] and quality != 0"), "n_chars % 7 - 3 > 0").select("doc_id")


@query(f"SELECT doc_id, NOT coalesce(quality = 1, false) AS skipped FROM {LABELLED} WHERE n_chars > 100")
def filter_pass_drop(spark, sf):
    return R.select_input(labelled(spark, sf), [("quality == 1", "pass"), ("n_chars > 100", "drop")], ("source",)).select("doc_id", F.col("_skip").alias("skipped"))


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def drop_fields(spark, sf):
    return R.select_input(t(spark, sf, "documents"), [], ("text", "absent")).drop("_err", "_skip")


@query("SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 50")
def limit_after_filter(spark, sf):
    return R.select_input(t(spark, sf, "documents"), [("lang == 'en'", "drop")], limit=50, order="doc_id").select("doc_id")


@query(f"SELECT doc_id, CASE WHEN coalesce(toxic, 0) = 1 THEN lang ELSE upper(lang) END AS lang, coalesce(toxic, 0) = 1 AS error FROM {LABELLED}")
def error_passthrough(spark, sf):
    d = labelled(spark, sf).select("doc_id", "lang", F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("error"))
    return R.write(d, "lang", F.upper("lang")).select("doc_id", "lang", "error")


# --- modifiers -------------------------------------------------------------------------------------------------------

@query("SELECT lang AS source, source AS lang, doc_id AS id FROM documents")
def rename_snapshot(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "source")
    return R.rename(d, {"lang": "source", "source": "lang", "doc_id": "id"})


@query("SELECT doc_id, lang, 'en' AS target, 3 AS version FROM documents")
def constants(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang")
    return R.constants(d, {"target": "en", "version": 3}).drop("_err", "_skip")


@query(f"SELECT doc_id, CASE WHEN coalesce(quality = 0, false) OR n_chars < 300 THEN 'short' ELSE 'ok' END AS route, CASE WHEN coalesce(quality = 0, false) OR n_chars < 300 THEN true END AS checked FROM {LABELLED}")
def set_when(spark, sf):
    d = labelled(spark, sf).withColumn("meta", F.struct(F.lit("ok").alias("route")))
    return R.set_when(d, "quality == 0 or n_chars < 300", {"meta.route": "short", "meta.checked": True}).select("doc_id", "meta.route", "meta.checked")


@query("SELECT doc_id, string_agg('C' || n || '=' || v, ';' ORDER BY n) AS items FROM (SELECT doc_id, v, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS n FROM (SELECT doc_id, unnest([lang, quality::VARCHAR, source]) AS v, unnest([1, 2, 3]) AS k FROM " + LABELLED + ") WHERE v IS NOT NULL) GROUP BY doc_id")
def candidates(spark, sf):
    d = R.candidates(labelled(spark, sf), "items", ["lang", "quality", "source"], "C", required=False)
    return d.select("doc_id", F.array_join(F.transform("items", lambda c: F.concat(c.id, F.lit("="), c.text)), ";").alias("items"))


@query("""WITH c AS (SELECT doc_id, list_filter([lang, quality::VARCHAR, source], lambda x: x IS NOT NULL) AS f FROM """ + LABELLED + """),
s AS (SELECT doc_id, list_sort(list_transform(range(len(f)), lambda i: {'k': md5(array_to_string(f, chr(31)) || chr(31) || i), 'x': f[i + 1]})) AS o FROM c)
SELECT doc_id, array_to_string(list_transform(range(len(o)), lambda i: 'C' || (i + 1) || '=' || o[i + 1].x), ';') AS items FROM s""")
def candidates_shuffled(spark, sf):
    d = R.candidates(labelled(spark, sf), "items", ["lang", "quality", "source"], "C", required=False, shuffle=True)
    return d.select("doc_id", F.array_join(F.transform("items", lambda c: F.concat(c.id, F.lit("="), c.text)), ";").alias("items"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source END AS picked, CASE WHEN doc_id % 3 = 2 THEN 'KeyError' END AS error_type FROM documents")
def select_by_id(spark, sf):
    d = R.candidates(t(spark, sf, "documents"), "items", ["lang", "source"], "C").withColumn("sel", F.concat(F.lit("C"), (F.col("doc_id") % 3 + 1).cast("string")))
    return R.fold_errors(R.select_by_id(d, "sel", "items", "picked"), "pick").select("doc_id", "picked", "error_type")


@query(f"SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), quality::VARCHAR, source) AS final_text FROM {LABELLED}")
def coalesce_final(spark, sf):
    d = labelled(spark, sf).withColumns({"a": F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")), "b": F.col("quality").cast("string")})
    return R.coalesce_fields(d, "final_text", ["a", "b", "source"]).select("doc_id", "final_text")


@query("""SELECT conv_id, 'S' || turn AS id, CASE WHEN turn = m AND conv_id % 2 = 0 THEN replace(replace(text, 'e', 'E'), 'E', '<e>') ELSE replace(text, 'e', 'E') END AS text, turn = m AND conv_id % 2 = 0 AS edited
FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS m, bool_or(turn = mt AND contains(replace(text, 'e', 'E'), 'E')) OVER (PARTITION BY conv_id) AS ok FROM (SELECT *, min(turn) OVER (PARTITION BY conv_id) AS mt FROM conversations WHERE text IS NOT NULL)) WHERE ok OR conv_id % 2 = 1""")
def apply_edits(spark, sf):
    s = segments(spark, sf)
    edit = F.struct(F.element_at("segments", 1).id.alias("segment_id"), F.lit("E").alias("span"), F.lit("<e>").alias("replacement"))
    d = s.withColumn("edits", F.when(F.col("conv_id") % 2 == 0, F.array(edit)).otherwise(F.slice(F.array(edit), 1, 0)))
    out = R.fold_errors(R.apply_edits(d, "edits", "segments", "result"), "adjust").where("error is null")
    return out.select("conv_id", F.explode("result").alias("r")).select("conv_id", "r.id", "r.text", "r.edited")


@query("SELECT l_orderkey AS k, CASE WHEN bool_or(l_returnflag IN ('A', 'R')) THEN 'needs_edit' ELSE 'publishable' END AS verdict, CASE WHEN bool_or(l_returnflag IN ('A', 'R')) THEN 'publishable' END AS model_verdict FROM lineitem GROUP BY 1")
def derive_verdict(spark, sf):
    g = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.struct(F.col("l_returnflag").alias("severity"))).alias("issues"))
    d = g.select("k", F.struct("issues", F.lit("publishable").alias("verdict")).alias("gate_answer"))
    return R.derive_verdict(d, severities=("A", "R")).select("k", "gate_answer.verdict", "gate_answer.model_verdict")


def order_lists(spark, sf):
    g = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", (F.col("l_suppkey") % 3).alias("s")))).alias("x"))
    return g.select("k", F.transform("x", lambda y: y.s).alias("items"), "x")


@query("SELECT l_orderkey AS k, string_agg(s::VARCHAR, ',' ORDER BY f, s) AS items FROM (SELECT l_orderkey, l_suppkey % 3 AS s, min(l_linenumber) AS f FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def list_dedup(spark, sf):
    return R.list_dedup(order_lists(spark, sf), "items").select("k", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query("SELECT l_orderkey AS k, string_agg(f::VARCHAR, ',' ORDER BY f) AS items FROM (SELECT l_orderkey, l_suppkey % 3 AS s, min(l_linenumber) AS f FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def list_dedup_key(spark, sf):
    return R.list_dedup(order_lists(spark, sf), "x", "s").select("k", F.array_join(F.transform("x", lambda y: y.l_linenumber.cast("string")), ",").alias("items"))


@query("SELECT l_orderkey AS k, least(count(*), 2)::BIGINT AS n, greatest(count(*) - 2, 0)::BIGINT AS overflow FROM lineitem GROUP BY 1")
def list_limit(spark, sf):
    return R.list_limit(order_lists(spark, sf), "items", 2, "overflow").select("k", F.size("items").cast("long").alias("n"), F.col("overflow").cast("long").alias("overflow"))


@query("SELECT l_orderkey AS k, least(count(*), 2)::BIGINT AS n FROM lineitem GROUP BY 1")
def list_pick(spark, sf):
    return R.list_pick(order_lists(spark, sf), "items", 2).select("k", F.size("items").cast("long").alias("n"))


SCRIPT_WORDS = [("cyrillic", "слово слава"), ("greek", "λόγος ἀρχή"), ("han", "漢字"), ("hebrew", "שלום"), ("thai", "คำว่าไทย"), ("katakana", "カタカナ"), (None, "plain")]


def scripted(spark, sf):
    """pairs whose target has a word of one script more, which a third of the sources have too."""
    words = F.array(*[F.lit(w) for _, w in SCRIPT_WORDS])
    word = F.concat(F.lit(" "), F.element_at(words, (F.col("doc_id") % len(SCRIPT_WORDS) + 1).cast("int")))
    d = t(spark, sf, "documents").withColumn("source_text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", word)).otherwise(F.col("text")))
    return d.select("doc_id", "source_text", F.concat("text", word).alias("target_text"))


SCRIPTED = "(SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || w ELSE text END AS source_text, text || w AS target_text FROM (SELECT doc_id, text, ' ' || [" + ", ".join(f"'{w}'" for _, w in SCRIPT_WORDS) + f"][doc_id % {len(SCRIPT_WORDS)} + 1] AS w FROM documents))"


def _leaks(source: str, target: str) -> str:
    """SQL of all foreign scripts with their first eight distinct characters, in the order of the ranges."""
    each = []
    for script in X.SCRIPT_RANGES:
        chars = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in X.SCRIPT_RANGES[script]) + "]"
        found = f"regexp_extract_all({target}, '{chars}')"
        once = f"list_filter(list_transform(range(len({found})), lambda i: CASE WHEN list_position({found}, {found}[i + 1]) = i + 1 THEN {found}[i + 1] END), lambda x: x IS NOT NULL)"
        each.append(f"CASE WHEN len({found}) > 0 AND NOT regexp_matches({source}, '{chars}') THEN '{script}=' || array_to_string({once}[1:8], '') || CASE WHEN len({once}) > 8 THEN '…' ELSE '' END END")
    return f"list_filter([{', '.join(each)}], lambda x: x IS NOT NULL)"


@query(f"SELECT doc_id, substr(list_filter(l, lambda x: x LIKE 'cyrillic=%')[1], 10) AS cyrillic FROM (SELECT doc_id, {_leaks('source_text', 'target_text')} AS l FROM {SCRIPTED})")
def transfer_script(spark, sf):
    return scripted(spark, sf).select("doc_id", F.try_element_at(X.foreign_scripts(F.col("source_text"), F.col("target_text")), F.lit("cyrillic")).alias("cyrillic"))


@query(f"SELECT doc_id, (NOT contains(target_text, 'https://ex.org/p' || doc_id || '?q=1'))::INT AS url FROM {PAIRS}")
def transfer_patterns(spark, sf):
    m = X.pattern_misses(F.col("source_text"), F.col("target_text"), ("url",))
    return pairs(spark, sf).select("doc_id", F.coalesce(F.size(F.try_element_at(m, F.lit("url"))), F.lit(0)).alias("url"))


@query(f"SELECT doc_id, CASE WHEN quality = 0 THEN true END AS error, CASE WHEN quality = 0 THEN 'ValueError' END AS error_type, CASE WHEN quality = 0 THEN 'gate' END AS error_stage, CASE WHEN quality IS DISTINCT FROM 0 THEN upper(lang) ELSE lang END AS lang FROM {LABELLED}")
def flag_record(spark, sf):
    d = R.fail_when(labelled(spark, sf), F.col("quality") == 0, "ValueError", "low quality")
    return R.fold_errors(R.write(d, "lang", F.upper("lang")), "gate").select("doc_id", "error", "error_type", "error_stage", "lang")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'gate:s1' END AS prov FROM documents")
def append_prov(spark, sf):
    d = R.select_input(t(spark, sf, "documents"), [("lang == 'en'", "pass")])
    d = R.append_provenance(d, {"stage": "gate", "sig": "s1", "attempt": 1})
    return d.select("doc_id", F.element_at("_prov", 1).stage.alias("s"), F.element_at("_prov", 1).sig.alias("g")).select("doc_id", F.concat("s", F.lit(":"), "g").alias("prov"))


# --- validators ------------------------------------------------------------------------------------------------------

@query(f"SELECT doc_id, length(target_text)::DOUBLE / length(source_text) < 0.9 OR length(target_text)::DOUBLE / length(source_text) > 1.2 AS bad FROM {PAIRS}")
def v_length_ratio(spark, sf):
    return pairs(spark, sf).select("doc_id", V.length_ratio(F.col("target_text"), F.col("source_text"), 0.9, 1.2).isNotNull().alias("bad"))


@query(f"SELECT doc_id, abs((length(target_text) - length(replace(target_text, 'en', ''))) // 2 - (length(source_text) - length(replace(source_text, 'en', ''))) // 2) > 3 AS bad FROM {PAIRS}")
def v_char_count(spark, sf):
    return pairs(spark, sf).select("doc_id", V.char_count(F.col("target_text"), F.col("source_text"), ["en"], 3).isNotNull().alias("bad"))


@query(f"SELECT doc_id, len({_leaks('source_text', 'target_text')}) > 0 AS bad FROM {SCRIPTED}")
def v_script(spark, sf):
    return scripted(spark, sf).select("doc_id", V.script_consistency(F.col("target_text"), F.col("source_text")).isNotNull().alias("bad"))


_URL_SQL = r"""(?i:https?://[^\s<>"''“”]+|www\.[^\s<>"''“”]+)"""
_EMAIL_SQL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_NUMBER_SQL = r"(?:[0-9]{1,3}(?:[ \x{A0}\x{202F}][0-9]{3})+(?:[.,][0-9]+)?|[0-9]+(?:[.,][0-9]+)*)"


def _numbers_sql(c: str, ordinals: str) -> str:
    """SQL of a text's numbers as digits; those that end in an ordinal's letters are left out where ordinals says so."""
    found = f"regexp_extract_all(regexp_replace({c}, '(?:[A-Za-z0-9._%+-]+@)?{_URL_SQL}|{_EMAIL_SQL}', '  ', 'g'), '{_NUMBER_SQL}(?:(?i:st|nd|rd|th|s)\\b)?')"
    return f"list_transform(list_filter({found}, lambda x: {ordinals}), lambda x: regexp_replace(x, '[^0-9]', '', 'g'))"


#: Per document the addresses that the target lacks, and its lost numbers, sorted, repeats included.
MISSES = rf"""(WITH p AS MATERIALIZED (SELECT * FROM {PAIRS}),
n AS (SELECT doc_id, unnest({_numbers_sql('source_text', "NOT regexp_matches(x, '[A-Za-z]$')")}) AS x, 1 AS k FROM p UNION ALL SELECT doc_id, unnest({_numbers_sql('target_text', 'true')}), -1 FROM p),
m AS (SELECT doc_id, string_agg(xs, ',' ORDER BY x) AS numbers FROM (SELECT doc_id, x, repeat(x || ',', sum(k)::INT - 1) || x AS xs FROM n GROUP BY 1, 2 HAVING sum(k) > 0) GROUP BY 1),
a AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(source_text, '{_URL_SQL}'), lambda x: rtrim(x, '.,;:!?…"'')]}}')), lambda x: x <> '' AND NOT contains(target_text, x)) AS u, list_filter(list_transform(regexp_extract_all(source_text, '{_EMAIL_SQL}'), lambda x: rtrim(x, '.,;:!?…"'')]}}')), lambda x: x <> '' AND NOT contains(target_text, x)) AS e FROM p)
SELECT doc_id, len(u)::BIGINT AS url, len(e)::BIGINT AS email, coalesce(numbers, '') AS number FROM a LEFT JOIN m USING (doc_id))"""


@query(f"SELECT doc_id, url + email > 0 OR number <> '' AS bad FROM {MISSES}")
def v_patterns(spark, sf):
    return pairs(spark, sf).select("doc_id", V.pattern_preservation(F.col("target_text"), F.col("source_text")).isNotNull().alias("bad"))


_WORDS = r"regexp_extract_all(replace(lower({c}), 'ß', 'ss'), '[\p{{L}}\p{{N}}_]+')"
_SRC, _TGT = _WORDS.format(c="source_text"), _WORDS.format(c="target_text")
_NGRAM = f"""
p AS MATERIALIZED (SELECT doc_id, {_SRC} AS s, {_TGT} AS t FROM {PAIRS}),
a AS (SELECT doc_id, array_to_string(t[i:i + 2], ' ') AS g, count(*) AS n, min(i) AS pos FROM (SELECT doc_id, t, unnest(range(1, greatest(len(t) - 2, 0) + 1)) AS i FROM p) GROUP BY 1, 2),
b AS (SELECT doc_id, array_to_string(s[i:i + 2], ' ') AS g, count(*) AS m FROM (SELECT doc_id, s, unnest(range(1, greatest(len(s) - 2, 0) + 1)) AS i FROM p) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY excess DESC, pos) AS k FROM (SELECT a.*, n - coalesce(m, 0) AS excess FROM a LEFT JOIN b USING (doc_id, g)) WHERE excess > 0)
"""


@query(f"WITH {_NGRAM} SELECT p.doc_id, coalesce(excess, 0) > 5 AS bad FROM p LEFT JOIN (SELECT * FROM r WHERE k = 1) x ON p.doc_id = x.doc_id")
def v_repetition(spark, sf):
    return V.repetition(pairs(spark, sf), "doc_id", "target_text", "source_text").select("doc_id", F.col("message").isNotNull().alias("bad"))


@query(f"WITH {_NGRAM} SELECT p.doc_id, g AS ngram, coalesce(n, 0)::BIGINT AS count, coalesce(excess, 0)::BIGINT AS excess FROM p LEFT JOIN (SELECT * FROM r WHERE k = 1) x ON p.doc_id = x.doc_id")
def repeated_ngram(spark, sf):
    return X.repeated_ngram(pairs(spark, sf), "doc_id", "target_text", "source_text")


@query()
def v_similarity(spark, sf):
    """Ratcliff-Obershelp of every pair of whole texts, failing only where the word Dice is low too."""
    return V.similarity(pairs(spark, sf), "doc_id", "target_text", "source_text", 0.8, 0.9).select("doc_id", F.round("ratio", 6).alias("ratio"), F.col("message").isNotNull().alias("bad"))


@query("""WITH s AS (SELECT conv_id, list({'id': 'S' || turn, 't': replace(lower(text), 'ß', 'ss'), 'u': replace(text, 'e', 'E')} ORDER BY turn) AS x FROM conversations WHERE text IS NOT NULL GROUP BY 1)
SELECT conv_id, (NOT contains(x[1].u, 'En'))::BIGINT + (NOT (contains(x[1].t, 'en') AND len(list_filter(x, lambda y: contains(y.t, 'en'))) >= 2))::BIGINT AS n FROM s""")
def v_edit_span(spark, sf):
    edit = F.struct(F.element_at("segments", 1).id.alias("segment_id"), F.lit("En").alias("span"), F.lit("X").alias("replacement"), F.lit(" En ").alias("source_term"))
    return segments(spark, sf).select("conv_id", F.size(V.edit_span(F.array(edit), F.col("segments"))).cast("long").alias("n"))


@query(f"SELECT doc_id, CASE WHEN length(target_text) < 0.9 * length(source_text) THEN 'length' WHEN len({_leaks('source_text', 'target_text')}) > 0 THEN 'script' END AS failed FROM {PAIRS}")
def v_chain(spark, sf):
    a = F.when(V.length_ratio(F.col("target_text"), F.col("source_text"), 0.9).isNotNull(), "length")
    b = F.when(V.script_consistency(F.col("target_text"), F.col("source_text")).isNotNull(), "script")
    return pairs(spark, sf).select("doc_id", V.chain(a, b).alias("failed"))


@query(f"SELECT doc_id, least(abs(length(source_text) - length(target_text)) / 10.0, 25)::DOUBLE > 5 AS bad FROM {PAIRS}")
def v_metricx(spark, sf):
    """The score check over a deterministic client: a tenth of the difference in length."""
    from sievework.operators import services as C

    d = C.score(pairs(spark, sf), lambda ps: [abs(len(a) - len(b)) / 10 for a, b in ps], "source_text", "target_text", "score")
    return d.select("doc_id", C.max_score(F.col("score"), 5).isNotNull().alias("bad"))


@query(f"SELECT doc_id, contains(target_text, 'слово') AND NOT contains(lower(source_text), 'слово') AS bad FROM {PAIRS}")
def v_languagetool(spark, sf):
    """The language check over a deterministic client that knows one wrong word; what the source says too is no finding."""
    from sievework.operators import services as C

    def client(text):
        at = text.find("слово")
        return [(at, 5, "WORD", "not a word here", ["word"])] if at >= 0 else []

    d = C.language_issues(pairs(spark, sf), client, "target_text", "issues")
    return d.select("doc_id", (F.size(V.findings_filter(F.col("issues"), F.col("source_text"))) > 0).alias("bad"))


# --- text functions --------------------------------------------------------------------------------------------------

@query(f"SELECT doc_id, array_to_string({_leaks('source_text', 'target_text')}, ',') AS found FROM {SCRIPTED}")
def foreign_scripts(spark, sf):
    m = X.foreign_scripts(F.col("source_text"), F.col("target_text"))
    return scripted(spark, sf).select("doc_id", F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e.key, F.lit("="), e.value)), ",").alias("found"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '(?i:https?://[^\s<>"''“”]+|www\.[^\s<>"''“”]+)'))::BIGINT AS n_urls, len(regexp_extract_all(html, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'))::BIGINT AS n_emails FROM pages""")
def extract_tokens(spark, sf):
    return t(spark, sf, "pages").select("page_id", F.size(X.urls(F.col("html"))).cast("long").alias("n_urls"), F.size(X.emails(F.col("html"))).cast("long").alias("n_emails"))


@query(r"""SELECT doc_id, array_to_string(list_transform(regexp_extract_all(source_text, '(?:[0-9]{1,3}(?:[ \x{A0}\x{202F}][0-9]{3})+(?:[.,][0-9]+)?|[0-9]+(?:[.,][0-9]+)*)'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), ',') AS numbers FROM """ + PAIRS)
def extract_numbers(spark, sf):
    return pairs(spark, sf).select("doc_id", F.array_join(X.numbers(F.col("source_text")), ",").alias("numbers"))


@query(f"SELECT * FROM {MISSES}")
def pattern_misses(spark, sf):
    d = pairs(spark, sf).withColumn("m", X.pattern_misses(F.col("source_text"), F.col("target_text")))
    of = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.array().cast("array<string>"))
    return d.select("doc_id", F.size(of("url")).cast("long").alias("url"), F.size(of("email")).cast("long").alias("email"), F.array_join(of("number"), ",").alias("number"))


@query(f"""WITH p AS (SELECT doc_id, {_SRC} AS s, {_TGT} AS t FROM {PAIRS}),
c AS (SELECT doc_id, w, sum(x) AS x, sum(y) AS y FROM (SELECT doc_id, left(unnest(s), 5) AS w, 1 AS x, 0 AS y FROM p UNION ALL SELECT doc_id, left(unnest(t), 5), 0, 1 FROM p) GROUP BY 1, 2)
SELECT doc_id, round(2 * sum(least(x, y))::DOUBLE / sum(x + y), 9) AS dice FROM c GROUP BY 1""")
def dice(spark, sf):
    return X.dice(pairs(spark, sf), "doc_id", "target_text", "source_text").select("doc_id", F.round("dice", 9).alias("dice"))


@query(f"SELECT doc_id, len({_SRC})::BIGINT AS n, {_SRC}[1] AS first FROM {PAIRS}")
def word_tokens(spark, sf):
    return pairs(spark, sf).select("doc_id", X.word_tokens(F.col("source_text")).alias("w")).select("doc_id", F.size("w").cast("long").alias("n"), F.element_at("w", 1).alias("first"))


@query(r"SELECT doc_id, trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '[\s\x{A0}]+', ' ', 'g')) AS text FROM documents")
def normalize_text(spark, sf):
    return t(spark, sf, "documents").select("doc_id", X.normalize_text(F.col("text")).alias("text"))


@query("SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE left(text, 79) || '…' END AS text FROM documents")
def truncate(spark, sf):
    return t(spark, sf, "documents").select("doc_id", X.truncate(F.col("text")).alias("text"))


@query("SELECT doc_id, substr(text, greatest(p - 40, 0) + 1, p - greatest(p - 40, 0)) || '«' || substr(text, p + 1, 5) || '»' || substr(text, p + 6, 40) AS context FROM (SELECT doc_id, text, (doc_id * 7) % greatest(length(text), 1) AS p FROM documents)")
def span_context(spark, sf):
    at = (F.col("doc_id") * 7) % F.greatest(F.length("text"), F.lit(1))
    return t(spark, sf, "documents").select("doc_id", X.span_context(F.col("text"), at.cast("int"), F.lit(5)).alias("context"))


@query("SELECT event_id, (props::JSON->>'k')::BIGINT AS k FROM events")
def json_roundtrip(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    return e.select("event_id", F.from_json(F.to_json("p"), "k long").k.alias("k"))


@query("""WITH a AS (SELECT l_orderkey AS k, l_suppkey % 3 AS s, sum((l_linenumber % 2 = 1)::INT) - sum((l_linenumber % 2 = 0)::INT) AS n FROM lineitem GROUP BY 1, 2)
SELECT k, coalesce(string_agg(repeat(s::VARCHAR, n::INT), '' ORDER BY s) FILTER (n > 0), '') AS diff FROM a GROUP BY 1""")
def multiset_diff(spark, sf):
    o = order_lists(spark, sf)
    side = lambda r: F.transform(F.filter("x", lambda y: y.l_linenumber % 2 == r), lambda y: y.s.cast("string"))
    return o.select("k", F.array_join(X.multiset_diff(side(1), side(0)), "").alias("diff"))


def issues(spark, sf):
    """Eight words spread over the whole text, first and last among them, as issues; the first one in capitals; and three that
    are not in it."""
    spread = lambda ws: F.when(F.size(ws) > 0, F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.get(ws, F.floor(i * (F.size(ws) - 1) / 7).cast("int")))).otherwise(F.array().cast("array<string>"))
    issue = lambda x, r: F.struct(x.alias("error_text"), F.lit(r).alias("rule_id"))
    more = lambda w: F.array(issue(F.upper(F.get(w, F.lit(0))), "R1"), issue(F.lit("zzqq"), "R2"), issue(F.lit("Zzqq"), "R2"), issue(F.lit(None).cast("string"), "R3"))
    made = X.let(X.let(X.space_words(F.col("text")), spread), lambda w: F.concat(F.transform(w, lambda x: issue(x, "R1")), more(w)))
    return t(spark, sf, "documents").select("doc_id", "text", made.alias("issues"))


ISSUES = r"""(SELECT doc_id, text, list_concat(list_transform(CASE WHEN len(w) > 0 THEN range(8) ELSE [] END, lambda i: {'t': w[(i * (len(w) - 1)) // 7 + 1], 'r': 'R1'}), [{'t': upper(w[1]), 'r': 'R1'}, {'t': 'zzqq', 'r': 'R2'}, {'t': 'Zzqq', 'r': 'R2'}, {'t': NULL, 'r': 'R3'}]) AS issues
FROM (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents))"""
FOLDED = "replace(lower({c}), 'ß', 'ss')"


@query(f"SELECT doc_id, len(list_filter(issues, lambda i: text = '' OR i.t IS NULL OR i.t = '' OR NOT contains(text, i.t)))::BIGINT AS n FROM {ISSUES}")
def suppress_verbatim(spark, sf):
    return issues(spark, sf).select("doc_id", F.size(V.suppress_verbatim(F.col("issues"), F.col("text"))).cast("long").alias("n"))


@query(f"""SELECT doc_id, array_to_string(list_transform(list_filter(issues, lambda i: (text = '' OR i.t IS NULL OR i.t = '' OR NOT contains({FOLDED.format(c='text')}, {FOLDED.format(c='i.t')})) AND NOT coalesce(regexp_matches(i.t, '^\\p{{Lu}}'), false)), lambda i: coalesce(i.t, i.r)), ',') AS "left" FROM {ISSUES}""")
def lt_findings_filter(spark, sf):
    kept = V.findings_filter(F.col("issues"), F.col("text"))
    return issues(spark, sf).select("doc_id", F.array_join(F.transform(kept, lambda i: F.coalesce(i.error_text, i.rule_id)), ",").alias("left"))


@query(f"SELECT doc_id, 'source: ' || source || ' candidate: ' || lang || CASE WHEN quality IS NULL THEN '' ELSE ' reference: ' || quality END AS input, 'candidate: ' || lang || ' source: ' || source AS second FROM {LABELLED}")
def metricx_input(spark, sf):
    from sievework.operators.services import scoring_input

    a, b = F.col("source"), F.col("lang")
    return labelled(spark, sf).select("doc_id", scoring_input(a, b, F.col("quality").cast("string")).alias("input"), scoring_input(a, b, candidate_first=True).alias("second"))


@query("SELECT n, least(60 * 2.0 ** (greatest(n, 1) - 1), 900)::DOUBLE AS delay FROM range(0, 12) r(n)")
def nak_delay(spark, sf):
    return spark.range(12).select(F.col("id").alias("n"), ST.nak_delay(F.col("id")).alias("delay"))


def _sig_chain_sql() -> str:
    """The chain as nested sha256 over the stages' canonical texts."""
    plan, sig, rows = P.example_plan(), "'input'", []
    for i, stage in enumerate(P.check(plan)):
        sig = f"left(sha256('{plan.version}|' || {sig} || '|{P.canonical(stage).replace("'", "''")}'), 8)"
        rows.append(f"SELECT {i}::INT AS \"index\", '{stage.id}' AS stage_id, {sig} AS sig")
    return " UNION ALL ".join(rows)


@query(_sig_chain_sql())
def sig_chain(spark, sf):
    """Signatures of a plan's stages, checked against a chain computed in SQL functions in the tests."""
    return P.signature_table(spark, P.example_plan())


# --- implicit joins --------------------------------------------------------------------------------------------------

@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf):
    return K.resume(t(spark, sf, "documents"), t(spark, sf, "labels"), "doc_id").select("doc_id")


CHUNKS = "(SELECT lpad(i::VARCHAR, 6, '0') AS chunk_id FROM range(300) r(i))"


def chunk_ids(spark):
    return spark.range(300).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("chunk_id"))


JOBS = f"(SELECT DISTINCT job FROM {DONE})"
TARGETS = f"(SELECT job, chunk_id FROM {JOBS}, {CHUNKS})"
_HAS = "(SELECT 1 FROM {d} d WHERE d.job = x.job AND d.chunk_id = x.chunk_id AND d.stage = {s})"


def targets(spark, sf):
    """Every chunk of every job: the jobs' list goes along with each chunk."""
    jobs = done_events(spark, sf).agg(F.collect_set("job").alias("jobs"))
    return chunk_ids(spark).join(F.broadcast(jobs)).select(F.explode("jobs").alias("job"), "chunk_id")


@query(f"SELECT job, chunk_id FROM {TARGETS} x WHERE NOT EXISTS {_HAS.format(d=DONE, s=0)}")
def seed_pending(spark, sf):
    return K.ready(targets(spark, sf), done_events(spark, sf), 0, ["job", "chunk_id"])


@query(f"SELECT job, chunk_id FROM {TARGETS} x WHERE EXISTS {_HAS.format(d=DONE, s=1)} AND NOT EXISTS {_HAS.format(d=DONE, s=2)}")
def rerun_missing(spark, sf):
    return K.ready(targets(spark, sf), done_events(spark, sf), 2, ["job", "chunk_id"])


@query(f"SELECT job, chunk_id FROM {TARGETS} x WHERE EXISTS {_HAS.format(d=DONE, s=0)} AND NOT EXISTS {_HAS.format(d=DONE, s=1)} AND NOT EXISTS (SELECT 1 FROM {DONE} d WHERE d.job = x.job AND d.chunk_id = x.chunk_id AND d.event_type = 'view')")
def reconcile(spark, sf):
    """Chunks whose stage is due, but not those that a queue holds (here: viewed ones)."""
    d = done_events(spark, sf)
    return K.resume(K.ready(targets(spark, sf), d, 1, ["job", "chunk_id"]), d.where("event_type = 'view'"), ["job", "chunk_id"])


@query(f"WITH d AS (SELECT DISTINCT job, stage, chunk_id FROM {DONE}), b AS (SELECT job, 0 AS stage, chunk_id FROM {TARGETS} UNION ALL SELECT job, stage + 1, chunk_id FROM d WHERE stage < 3) SELECT b.job, b.stage, b.chunk_id FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.job = b.job AND d.stage = b.stage AND d.chunk_id = b.chunk_id)")
def missing_chunks(spark, sf):
    return K.missing_chunks(targets(spark, sf), done_events(spark, sf), 4, ("job",))


@query("SELECT requires, (SELECT count(DISTINCT s_suppkey) FROM supplier WHERE s_nationkey % 5 = r AND s_suppkey % 3 = q)::BIGINT AS n_workers FROM (SELECT DISTINCT 'n' || (p_partkey % 5) || ',m' || (p_size % 3) AS requires, p_partkey % 5 AS r, p_size % 3 AS q FROM part)")
def capability_match(spark, sf):
    tag = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    tasks = t(spark, sf, "part").select(F.array(tag("n", F.col("p_partkey") % 5), tag("m", F.col("p_size") % 3)).alias("requires"))
    workers = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("worker_id"), F.array(tag("n", F.col("s_nationkey") % 5), tag("m", F.col("s_suppkey") % 3)).alias("capabilities"))
    return K.capability_match(tasks, workers).select(F.array_join("requires", ",").alias("requires"), "n_workers")


@query("""WITH e AS (SELECT o_orderkey AS k, i AS item FROM orders, range(1, 5) r(i)), r AS (SELECT l_orderkey AS k, l_suppkey % 5 AS item, count(*) AS n, min(l_shipdate::DATE::VARCHAR) AS reply FROM lineitem GROUP BY 1, 2)
SELECT e.k, e.item, r.reply, r.reply IS NOT NULL AS answered FROM e LEFT JOIN r ON e.k = r.k AND e.item = r.item AND r.n = 1""")
def align_items(spark, sf):
    expected = t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.explode(F.expr("sequence(1L, 4L)")).alias("item"))
    replies = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), (F.col("l_suppkey") % 5).alias("item"), F.col("l_shipdate").cast("date").cast("string").alias("reply"))
    return K.align_items(expected, replies, "k", "item")


def runs(spark, sf):
    base = labelled(spark, sf).select("doc_id", F.lit("base").alias("run"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("error"))
    rerun = base.where("doc_id % 2 = 0").select("doc_id", F.lit("rerun").alias("run"), (F.col("doc_id") % 6 == 0).alias("error"))
    return base, rerun


RUNS = f"(SELECT doc_id, 'base' AS run, 0 AS i, coalesce(toxic = 1, false) AS error FROM {LABELLED} UNION ALL SELECT doc_id, 'rerun', 1, doc_id % 6 = 0 FROM documents WHERE doc_id % 2 = 0)"


@query(f"SELECT doc_id, run, error FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY error, i DESC) AS r FROM {RUNS}) WHERE r = 1")
def combine_runs(spark, sf):
    return K.combine_runs(list(runs(spark, sf)), "doc_id").select("doc_id", "run", "error")


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 1 OR doc_id % 6 = 0")
def pull_failed(spark, sf):
    return K.pull_failed(t(spark, sf, "documents"), runs(spark, sf)[1], "doc_id").select("doc_id")


@query("SELECT o_orderkey AS source_id, count(*) FILTER (l_returnflag = 'N') AS queries, count(*) FILTER (l_returnflag = 'A') AS others FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def rejoin_segments(spark, sf):
    segments_ = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_returnflag").alias("kind"))
    rows = t(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id"))
    return RP.rejoin_segments(segments_, rows, "source_id", "kind", {"queries": "N", "others": "A"})


@query("""SELECT o_orderkey AS source_id, coalesce(string_agg(l_linenumber || ':' || l_linestatus, ',' ORDER BY l_linenumber, l_linestatus) FILTER (l_returnflag = 'N'), '') AS queries, coalesce(string_agg(l_linenumber || ':' || l_linestatus, ',' ORDER BY l_linenumber, l_linestatus) FILTER (l_returnflag = 'A'), '') AS others
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def rejoin_items(spark, sf):
    """Each order with its own lines, by kind and in order, those without any too."""
    lines = t(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "source_id")
    out = RP.gather_segments(lines, t(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id")), "source_id", "l_returnflag", {"queries": "N", "others": "A"}, "l_linenumber", ["l_linenumber", "l_linestatus"])
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["l_linenumber"].cast("string"), F.lit(":"), x["l_linestatus"])), ",")
    return out.select("source_id", text("queries").alias("queries"), text("others").alias("others"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN lang WHEN doc_id % 2 = 0 THEN source ELSE '' END AS text, CASE WHEN doc_id % 3 > 0 THEN 'run' WHEN doc_id % 2 = 0 THEN 'fallback' ELSE 'none' END AS origin FROM documents")
def fill_gaps(spark, sf):
    d = t(spark, sf, "documents")
    base = d.select("doc_id", F.when(F.col("doc_id") % 3 > 0, F.col("lang")).otherwise("").alias("text"), F.lit("same").alias("src"))
    fb = d.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise("same").alias("text"))
    return K.fill_gaps(base, fb, "doc_id", "text", "src").select("doc_id", "text", "origin")


def scores(spark, sf):
    d = labelled(spark, sf)
    s = lambda m: ((F.col("doc_id") * m) % 251).cast("double") / 10
    route = F.when(F.col("quality") == 0, "needs_edit").when(F.col("quality") == 1, "clean").otherwise("minor_fix")
    return d.select("doc_id", s(37).alias("a"), F.when(F.col("doc_id") % 4 == 0, s(37)).otherwise(s(91)).alias("b"), route.alias("route"))


SCORES = f"(SELECT doc_id, ((doc_id * 37) % 251)::DOUBLE / 10 AS a, CASE WHEN doc_id % 4 = 0 THEN ((doc_id * 37) % 251)::DOUBLE / 10 ELSE ((doc_id * 91) % 251)::DOUBLE / 10 END AS b, CASE quality WHEN 0 THEN 'needs_edit' WHEN 1 THEN 'clean' ELSE 'minor_fix' END AS route FROM {LABELLED})"


@query(f"SELECT doc_id, a, b, round(b - a, 6) AS delta FROM {SCORES}")
def compare_systems(spark, sf):
    s = scores(spark, sf)
    systems = {"a": s.select("doc_id", F.col("a").alias("score")), "b": s.select("doc_id", F.col("b").alias("score"))}
    return RP.compare_systems(systems, "doc_id", "score", "a").withColumnRenamed("delta_b", "delta")


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), c AS (SELECT x.vec_id AS a, y.vec_id AS b, list_dot_product(x.e, y.e) AS c FROM v x, v y WHERE x.vec_id % 2 = 0 AND y.vec_id % 2 = 1),
ab AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM c), ba AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY c DESC, a) AS r FROM c),
ma AS (SELECT a, avg(c) AS m FROM ab WHERE r <= 4 GROUP BY 1), mb AS (SELECT b, avg(c) AS m FROM ba WHERE r <= 4 GROUP BY 1)
SELECT ab.a AS a_id, ab.b AS b_id, round(ab.c, 6) AS cosine, round(ab.c / ((ma.m + mb.m) / 2), 6) AS margin FROM ab JOIN ba ON ab.a = ba.a AND ab.b = ba.b AND ab.r = 1 AND ba.r = 1 JOIN ma ON ma.a = ab.a JOIN mb ON mb.b = ab.b""")
def margin_ratio(spark, sf):
    v = t(spark, sf, "embeddings")
    m = K.margin_ratio(v.where("vec_id % 2 = 0"), v.where("vec_id % 2 = 1"), "vec_id", "embedding")
    return m.select("a_id", "b_id", F.round("cosine", 6).alias("cosine"), F.round("margin", 6).alias("margin"))


# --- aggregations ----------------------------------------------------------------------------------------------------

@query(f"SELECT job, stage, event_type, sum(event_id % 3)::BIGINT AS n FROM {DONE} WHERE event_type IN ('error', 'view') GROUP BY 1, 2, 3")
def flagged_by_type(spark, sf):
    """Sums of the events' own counts."""
    d = done_events(spark, sf).where("event_type in ('error', 'view')").withColumn("k", F.col("event_id") % 3)
    return RP.flagged_by_type(d, ["job", "stage", "event_type"], "k")


@query(f"SELECT sum(CASE WHEN flagged THEN event_id % 3 ELSE 0 END)::BIGINT AS errored FROM {DONE}")
def total_errored(spark, sf):
    return RP.total_flagged(done_events(spark, sf).withColumn("k", F.col("event_id") % 3), "k")


@query(f"SELECT chunk_id, sum((event_type <> 'view')::INT)::BIGINT AS ran, sum((event_type IN ('error', 'click'))::INT)::BIGINT AS bad FROM {DONE} GROUP BY 1 HAVING ran > 0 AND bad > 0.5 * ran")
def outage_chunks(spark, sf):
    d = done_events(spark, sf).select("chunk_id", (F.col("event_type") == "view").alias("skipped"), F.col("event_type").isin("error", "click").alias("connection_error"))
    return K.outage_chunks(d)


@query(f"""WITH d AS (SELECT DISTINCT job, stage, chunk_id FROM {DONE}), n AS (SELECT job, stage, count(*) AS done FROM d GROUP BY 1, 2),
m AS (SELECT job, stage, string_agg(chunk_id, ',' ORDER BY chunk_id) AS ids FROM (SELECT job, stage, c.chunk_id FROM (SELECT DISTINCT job, stage FROM d), {CHUNKS} c EXCEPT SELECT * FROM d) GROUP BY 1, 2)
SELECT job, stage, done, 300 - done AS missing, CASE WHEN 300 - done <= 8 THEN ids END AS missing_ids FROM n LEFT JOIN m USING (job, stage)""")
def job_status(spark, sf):
    d = done_events(spark, sf)
    return RP.job_status(d, chunk_ids(spark), d.select("job", "stage"), ("job",))


@query(f"SELECT job, count(DISTINCT chunk_id) >= 280 AS complete FROM {DONE} WHERE stage = 3 GROUP BY 1")
def job_complete(spark, sf):
    return RP.job_complete(done_events(spark, sf), 3, 280)


@query(f"SELECT job, stage, count(*) AS n FROM (SELECT job, stage, chunk_id, count(*) AS k FROM {DONE} WHERE flagged GROUP BY 1, 2, 3) WHERE k >= 3 GROUP BY 1, 2")
def dead_letters(spark, sf):
    """Messages delivered three times without success, per stage."""
    return RP.dead_letters(done_events(spark, sf).where("flagged"), ["job", "stage"])


@query(f"SELECT count(*) AS n, count(*) FILTER (a >= 20) AS dropped, round(avg(a), 6) AS mean, round(median(a), 6) AS p50, round(stddev_samp(a), 6) AS std, min(a) AS low, max(a) AS high, round(quantile_cont(a, 0.1), 6) AS p10, round(quantile_cont(a, 0.9), 6) AS p90 FROM {SCORES}")
def score_summary(spark, sf):
    return RP.score_summary(scores(spark, sf), "a", 20)


BUCKET = "CASE WHEN a < 1 THEN '0-1' WHEN a < 3 THEN '1-3' WHEN a < 6 THEN '3-6' ELSE '6-25' END"


@query(f"SELECT {BUCKET} AS bucket, count(*) AS n FROM {SCORES} GROUP BY 1")
def score_buckets(spark, sf):
    return RP.score_buckets(scores(spark, sf), "a", [0, 1, 3, 6, 25])


@query(f"SELECT route, count(*) AS n, round(avg(a), 6) AS mean_a, round(avg(b), 6) AS mean_b FROM {SCORES} GROUP BY 1")
def route_breakdown(spark, sf):
    return RP.breakdown(scores(spark, sf), "route", ["a", "b"])


@query(f"SELECT count(*) FILTER (b < a) AS wins, count(*) FILTER (a = b) AS ties, count(*) FILTER (b > a) AS losses, round(avg(b - a), 6) AS delta FROM {SCORES}")
def win_tie_loss(spark, sf):
    return RP.win_tie_loss(scores(spark, sf), "b", "a")


W64 = f"{2**64}::UHUGEINT"


@query(f"""WITH b AS (SELECT b - a AS d, ('0x' || left(md5(doc_id::VARCHAR), 16))::UBIGINT::UHUGEINT AS h FROM {SCORES}),
x AS (SELECT d, g, (h + (g + 1)::UHUGEINT * {0x9E3779B97F4A7C15}::UHUGEINT + 7::UHUGEINT * {0xD6E8FEB86659FD93}::UHUGEINT) % {W64} AS x FROM b, range(250) t(g)),
y AS (SELECT d, g, xor(x, x >> 30) * {0xBF58476D1CE4E5B9}::UHUGEINT % {W64} AS x FROM x), z AS (SELECT d, g, xor(x, x >> 27) * {0x94D049BB133111EB}::UHUGEINT % {W64} AS x FROM y),
u AS (SELECT d, g * 4 + j AS draw, ((xor(x, x >> 31) >> (16 * j)::UHUGEINT) % 65536::UHUGEINT)::INT AS u FROM z, range(4) t(j)),
k AS (SELECT d, draw, {" + ".join(f"(u >= {int(x)})::INT" for x in ST.poisson_bounds())} AS k FROM u),
m AS (SELECT draw, sum(k * d) / sum(k) AS m FROM k GROUP BY draw)
SELECT round(avg(m), 6) AS mean, round(quantile_cont(m, 0.025), 6) AS low, round(quantile_cont(m, 0.975), 6) AS high FROM m""")
def paired_bootstrap(spark, sf):
    out = ST.paired_bootstrap(scores(spark, sf).select("doc_id", (F.col("b") - F.col("a")).alias("d")), "d", "doc_id", draws=1000, seed=7)
    return out.select(*[F.round(c, 6).alias(c) for c in ("mean", "low", "high")])


@query(f"SELECT route, count(*) AS n, count(*) FILTER (a >= 20) AS dropped, round(avg(a), 6) AS mean, round(stddev_samp(a), 6) AS std, min(a) AS low, max(a) AS high, true AS near FROM {SCORES} GROUP BY route")
def score_parts(spark, sf):
    """Sketches by chunk and route, merged by route; near: whether the median's rank is right within the sketch's error."""
    s = scores(spark, sf)
    parts = RP.score_sketches(s.withColumn("chunk", F.col("doc_id") % 16), ["chunk", "route"], "a", 20)
    out = RP.sketch_summary(RP.merged_sketches(parts, ["route"]))
    ranks = s.join(out.select("route", "p50"), "route").groupBy("route").agg(F.avg((F.col("a") < F.col("p50")).cast("int")).alias("below"), F.avg((F.col("a") <= F.col("p50")).cast("int")).alias("upto"))
    near = (F.col("below") <= 0.5 + 2 * RP.RANK_ERROR) & (F.col("upto") >= 0.5 - 2 * RP.RANK_ERROR)
    return out.join(ranks, "route").select("route", "n", "dropped", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "low", "high", near.alias("near"))


@query(f"SELECT job, hour, n, n - coalesce(p, 0) AS delta FROM (SELECT *, lag(n) OVER (PARTITION BY job ORDER BY hour) AS p FROM (SELECT job, date_trunc('hour', ts) AS hour, sum(count(*)) OVER (PARTITION BY job ORDER BY date_trunc('hour', ts))::BIGINT AS n FROM {DONE} GROUP BY 1, 2)) WHERE n - coalesce(p, 0) >= 3")
def redelivery_spike(spark, sf):
    """Growth of a cumulative counter between looks."""
    return RP.growth(done_events(spark, sf), "job", F.date_trunc("hour", "ts"), 3, name="hour")


# --- order, chunks ---------------------------------------------------------------------------------------------------

RANK = "CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END"


@query(f"SELECT doc_id, md5(text) AS text_md5, row_number() OVER (ORDER BY {RANK}, doc_id) - 1 AS pos FROM documents")
def priority_order(spark, sf):
    """All columns of a row stay with its place."""
    d = t(spark, sf, "documents").withColumn("key", F.struct(R.priority_rank("lang", ["en", "de"]).alias("r"), "doc_id"))
    return K.with_order(d, "key", "pos").select("doc_id", F.md5("text").alias("text_md5"), F.col("pos").cast("long").alias("pos"))


@query(f"SELECT doc_id, md5(text) AS text_md5, source, lpad(p::VARCHAR, 8, '0') AS seed_id, lpad((p // 20)::VARCHAR, 6, '0') AS chunk_id FROM (SELECT *, row_number() OVER (ORDER BY {RANK}, doc_id) - 1 AS p FROM documents)")
def seed_chunks(spark, sf):
    return K.seed_chunks(t(spark, sf, "documents"), "doc_id", "lang", ["en", "de"]).select("doc_id", F.md5("text").alias("text_md5"), "source", "seed_id", "chunk_id")


@query("SELECT doc_id, doc_id // 20 AS chunk, (row_number() OVER (PARTITION BY doc_id // 20 ORDER BY doc_id) - 1) // 6 AS grp FROM documents")
def batch_groups(spark, sf):
    return RP.batch_groups(t(spark, sf, "documents").select("doc_id"), F.floor(F.col("doc_id") / 20), "doc_id", 6)


@query(f"(SELECT 'worst' AS side, doc_id, round(b - a, 6) AS delta FROM {SCORES} ORDER BY round(b - a, 6) DESC, doc_id LIMIT 10) UNION ALL (SELECT 'best', doc_id, round(b - a, 6) FROM {SCORES} ORDER BY round(b - a, 6), doc_id LIMIT 10)")
def top_regressions(spark, sf):
    delta = F.round(F.col("b") - F.col("a"), 6)
    side = lambda name, worst: RP.top_changes(scores(spark, sf), "doc_id", delta, 10, worst).withColumn("side", F.lit(name))
    return side("worst", True).unionByName(side("best", False)).select("side", "doc_id", "delta")


PLANS = "(SELECT user_id % 50 AS stage, user_id // 50 % 2 AS half, min(event_type) || ',' || count(*) % 3 AS sig FROM events GROUP BY 1, 2)"


@query(f"SELECT coalesce(o.stage, n.stage) AS stage FROM (SELECT * FROM {PLANS} WHERE half = 0) o FULL JOIN (SELECT * FROM {PLANS} WHERE half = 1) n ON o.stage = n.stage WHERE o.sig IS DISTINCT FROM n.sig")
def plan_diff(spark, sf):
    e = t(spark, sf, "events").groupBy((F.col("user_id") % 50).alias("stage"), (F.floor(F.col("user_id") / 50) % 2).alias("half"))
    plans = e.agg(F.concat_ws(",", F.min("event_type"), (F.count("*") % 3).cast("string")).alias("sig"))
    return RP.invalidated(plans.where("half = 0"), plans.where("half = 1"))


@query(f"WITH d AS (SELECT DISTINCT stage, event_type AS sig FROM {DONE}) SELECT d.stage, d.sig FROM d WHERE NOT EXISTS (SELECT 1 FROM (VALUES (0, 'view'), (1, 'click'), (2, 'error')) p(stage, sig) WHERE p.stage = d.stage AND p.sig = d.sig)")
def gc_dead(spark, sf):
    live = spark.createDataFrame([(0, "view"), (1, "click"), (2, "error")], "stage int, sig string")
    return RP.dead_outputs(done_events(spark, sf).select("stage", F.col("event_type").alias("sig")), live, ["stage", "sig"])


# --- event logic, batch forms ----------------------------------------------------------------------------------------

@query(f"SELECT event_id, job FROM (SELECT *, lag(ts) OVER (PARTITION BY job, stage ORDER BY ts, event_id) AS p FROM {DONE}) WHERE p IS NULL OR ts - p > INTERVAL 120 SECOND")
def stream_dedup(spark, sf):
    """Batch form: a message is new if no equal one came in the 120 s before it."""
    w = Window.partitionBy("job", "stage").orderBy("ts", "event_id")
    d = done_events(spark, sf).withColumn("p", F.lag("ts").over(w))
    return d.where(F.col("p").isNull() | (ST.micros("ts") - ST.micros("p") > 120_000_000)).select("event_id", "job")


@query(f"SELECT event_id, job, stage, n FROM (SELECT *, sum(20 + event_id % 10) OVER (PARTITION BY job, stage ORDER BY ts RANGE BETWEEN INTERVAL 600 SECOND PRECEDING AND CURRENT ROW)::BIGINT AS n FROM {DONE}) WHERE n >= 25")
def flag_spike(spark, sf):
    """Sums of the events' own counts over 600 s, from 25 on."""
    d = done_events(spark, sf).withColumn("k", 20 + F.col("event_id") % 10)
    return ST.flag_spikes(d, ["job", "stage"], "ts", count="k").select("event_id", "job", "stage", "n")


@query(f"SELECT worker_id, max(ts) AS seen FROM {DONE} GROUP BY 1 HAVING max(ts) >= (SELECT max(ts) FROM events) - INTERVAL 1800 SECOND")
def alive_workers(spark, sf):
    return ST.alive(done_events(spark, sf), "worker_id", "ts", seconds=1800).select("worker_id", "seen")


@query(f"""WITH RECURSIVE e AS (SELECT job, epoch(ts) AS s, event_id, row_number() OVER (PARTITION BY job ORDER BY ts, event_id) AS k FROM {DONE} WHERE flagged),
r AS (SELECT job, k, event_id, s, s AS fired, true AS fire FROM e WHERE k = 1 UNION ALL SELECT e.job, e.k, e.event_id, e.s, CASE WHEN e.s - fired >= 3600 THEN e.s ELSE fired END, e.s - fired >= 3600 FROM r JOIN e ON e.job = r.job AND e.k = r.k + 1)
SELECT job, event_id FROM r WHERE fire""")
def alert_cooldown(spark, sf):
    return ST.cooldown(done_events(spark, sf).where("flagged"), "job", "ts", "event_id", seconds=3600).select("job", "event_id")


@query(f"""WITH h AS (SELECT job, date_trunc('hour', ts) AS tick, count(*) FILTER (event_type = 'purchase') AS busy FROM {DONE} GROUP BY 1, 2), g AS (SELECT *, sum((busy > 0)::INT) OVER (PARTITION BY job ORDER BY tick) AS run FROM h)
SELECT job, tick FROM (SELECT *, row_number() OVER (PARTITION BY job, run ORDER BY tick) - (CASE WHEN run > 0 THEN 1 ELSE 0 END) AS idle FROM g) WHERE idle = 3""")
def drained_jobs(spark, sf):
    """The third tick in a row at which an incomplete job is idle."""
    h = done_events(spark, sf).groupBy("job", F.date_trunc("hour", "ts").alias("tick")).agg(F.count_if(F.col("event_type") == "purchase").alias("busy"))
    return ST.idle_ticks(h, "job", "tick", "busy", 3)


@query(f"SELECT event_id FROM {DONE} WHERE (job, stage, event_type) IN (VALUES ('j0', 0, 'view'), ('j1', 1, 'click')) AND event_id > 500")
def replay_done(spark, sf):
    """Events of the current plan alone (stragglers of an old one are ignored), after the floor."""
    plan = spark.createDataFrame([("j0", 0, "view", 500), ("j1", 1, "click", 500)], "job string, stage int, event_type string, floor long")
    return RP.current_events(done_events(spark, sf), plan, ["job", "stage", "event_type"], "event_id").select("event_id")


@query(f"SELECT event_id, chunk_id NOT IN (SELECT lpad(doc_id::VARCHAR, 6, '0') FROM labels) AS ghost FROM {DONE} WHERE flagged")
def ghost_events(spark, sf):
    objects = t(spark, sf, "labels").select(F.lpad(F.col("doc_id").cast("string"), 6, "0").alias("chunk_id"))
    return RP.with_ghosts(done_events(spark, sf).where("flagged"), objects, "chunk_id").select("event_id", "ghost")


@query(f"SELECT chunk_id, CASE WHEN a <= 60 THEN 'fresh' WHEN a <= 120 THEN 'stale' ELSE 'expired' END AS lease FROM (SELECT chunk_id, epoch((SELECT max(ts) FROM events)) - epoch(max(ts)) AS a FROM {DONE} GROUP BY 1)")
def lease_state(spark, sf):
    return ST.lease_state(done_events(spark, sf), "chunk_id", "ts")


@query("SELECT 'running' AS state, count(*) AS records, NULL::VARCHAR AS note FROM documents".replace(", NULL::VARCHAR AS note", ""))
def job_detail(spark, sf):
    d = t(spark, sf, "documents").agg(F.count("*").alias("records")).withColumn("state", F.lit("running"))
    return S.envelope(d).select(F.from_json("status", "state string, records long").alias("s")).select("s.state", "s.records")



@query(f"""WITH e AS (SELECT DISTINCT chunk_id, epoch_us(ts) AS m FROM {DONE} WHERE ts IS NOT NULL),
g AS (SELECT chunk_id, m, coalesce(lead(m) OVER w, (SELECT max(m) FROM e)) - m AS gap, m - lag(m) OVER w AS back FROM e WINDOW w AS (PARTITION BY chunk_id ORDER BY m))
SELECT chunk_id, m AS at_us, 'fresh' AS lease FROM g WHERE coalesce(back > 60000000, true) UNION ALL SELECT chunk_id, m + 60000000, 'stale' FROM g WHERE gap > 60000000 UNION ALL SELECT chunk_id, m + 120000000, 'expired' FROM g WHERE gap > 120000000""")
def lease_transitions(spark, sf):
    return ST.lease_transitions(done_events(spark, sf), "chunk_id", "ts").select("chunk_id", F.col("at").alias("at_us"), "lease")


@query(f"""WITH r AS (SELECT job, event_type AS kind, epoch_us(ts) AS f, max(CASE WHEN flagged THEN 0 ELSE stage END) AS q FROM {DONE} WHERE ts IS NOT NULL GROUP BY ALL),
u AS (SELECT *, least(coalesce(lead(f) OVER (PARTITION BY job, kind ORDER BY f), f + 7200000000), f + 7200000000, (SELECT max(f) + 1 FROM r)) AS t FROM r)
SELECT job, m AS at_us, count(*)::INT AS stages, sum(q)::BIGINT AS queued, string_agg(kind, ',' ORDER BY kind) AS names
FROM (SELECT job, kind, q, unnest(range((f + 3599999999) // 3600000000 * 3600000000, t, 3600000000)) AS m FROM u WHERE q > 0) GROUP BY job, m""")
def stall_digest(spark, sf):
    """The hourly digest of each job's stalled stages; a report of 0 (here: an error) says that a stage is not stalled."""
    e = done_events(spark, sf).withColumn("queued", F.when(F.col("flagged"), 0).otherwise(F.col("stage")))
    return ST.stall_digest(e, "job", "ts", "event_type", "queued").select("job", F.col("at").alias("at_us"), "stages", "queued", "names")


# --- whole records, jobs on the store ------------------------------------------------------------------------------------

def mixed_records(spark, sf):
    """JSON records of unlike schemas: x is null, absent, a number, an object, a list, a text or a truth."""
    d = t(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    k = F.col("doc_id") % 8
    tail = F.concat(F.lit('"z": '), F.col("n_chars").cast("string"), F.lit("}"))
    x = F.when(k == 0, '"x": null, ').when(k == 1, "").when(k == 2, '"x": 4, ').when(k == 3, '"x": {"y": [1, 2]}, ').when(k == 4, '"x": [{"y": 1}], ').when(k == 5, F.concat(F.lit('"x": "'), F.col("lang"), F.lit('", '))).when(k == 6, '"x": 4.0, ').otherwise('"x": true, ')
    return d.select("doc_id", F.parse_json(F.concat(F.lit("{"), x, tail)).alias("record"))


#: Expressions over them, and the same in SQL; j is the record, x its field, k the field's type (NULL: absent).
EXACT = {
    "x == None": "coalesce(k = 'NULL', false)",
    "x == gone": "k IS NULL",
    "x != 4": "NOT coalesce(n = 4, false)",
    "x": "coalesce(k NOT IN ('NULL'), false)",
    "not x or z > 500": "coalesce(k = 'NULL', true) OR z > 500",
    "x.y[0] == 1": "coalesce((j -> '$.x.y[0]')::VARCHAR = '1', false)",
    "x.y == gone": "coalesce(k <> 'OBJECT', true)",
    "x[0].y == 1": "coalesce((j -> '$.x[0].y')::VARCHAR = '1', false)",
    "x >= 4": "coalesce(n >= 4, false)",
    "x in [4, null, 'en']": "coalesce(n = 4 OR k = 'NULL' OR x::VARCHAR = '\"en\"', false)",
    "len(x) == 1": "coalesce(k IN ('OBJECT', 'ARRAY'), false)",
    "x is true and z % 2 == 1": "coalesce(x::VARCHAR = 'true', false) AND z % 2 = 1",
    "'y' in x": "coalesce(k = 'OBJECT', false)",
}
MIXED = """(SELECT doc_id, j, j -> '$.x' AS x, json_type(j, '$.x') AS k, CASE WHEN json_type(j, '$.x') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN (j ->> '$.x')::DOUBLE WHEN json_type(j, '$.x') = 'BOOLEAN' THEN (j ->> '$.x')::BOOLEAN::INT END AS n, (j ->> '$.z')::BIGINT AS z
FROM (SELECT doc_id, ('{' || CASE doc_id % 8 WHEN 0 THEN '"x": null, ' WHEN 1 THEN '' WHEN 2 THEN '"x": 4, ' WHEN 3 THEN '"x": {"y": [1, 2]}, ' WHEN 4 THEN '"x": [{"y": 1}], ' WHEN 5 THEN '"x": "' || lang || '", ' WHEN 6 THEN '"x": 4.0, ' ELSE '"x": true, ' END || '"z": ' || n_chars || '}')::JSON AS j FROM documents))"""


@query(" UNION ALL ".join(f"SELECT doc_id, '{e.replace(chr(39), chr(39) * 2)}' AS expression, {sql} AS holds FROM {MIXED}" for e, sql in EXACT.items()))
def exact_filter(spark, sf):
    """Every expression's truth for every record: an absent field, a null and a list in mid-path differ."""
    d = mixed_records(spark, sf)
    held = [F.struct(F.lit(e).alias("expression"), EX.compile_exact(e).alias("holds")) for e in EXACT]
    return d.select("doc_id", F.explode(F.array(*held)).alias("x")).select("doc_id", "x.expression", "x.holds")


@query(f"SELECT doc_id, (j -> '$.x.y')::VARCHAR AS y, coalesce(k = 'OBJECT', false) AS kept FROM {MIXED}")
def exact_paths(spark, sf):
    """A dotted path walks objects alone; a set one builds its parents, and leaves other fields as they are."""
    d = mixed_records(spark, sf)
    new = EX.set_path(F.col("record"), "x.new", F.lit(1).cast("variant"))
    return d.withColumn("after", new).select("doc_id", F.to_json(EX.get_path(F.col("record"), "x.y")).alias("y"), EX.compile_exact("x.new == 1 and x.y != gone", "after").alias("kept"))


JOB_PLAN = P.Plan("job", (P.Stage("long", "constants", {"values": {"kind": "long"}}, filters=(("n_chars > 900", "drop"),)), P.Stage("route", "set_when", {"when": "lang == 'en'", "values": {"route": "home"}}), P.Stage("first", "coalesce", {"target": "out", "sources": ["route", "lang"]}, limit=300)))
JOB = "s AS (SELECT *, lpad(((row_number() OVER (ORDER BY doc_id) - 1) // 20)::VARCHAR, 6, '0') AS chunk_id FROM documents), k AS (SELECT * FROM s WHERE n_chars > 900), l AS (SELECT * FROM k ORDER BY doc_id LIMIT 300), c AS (SELECT DISTINCT chunk_id FROM s)"


def finished_job(spark, sf):
    """A job over all documents, run to its end in two goes."""
    root = S.scratch(spark, "job")
    J.seed(spark, t(spark, sf, "documents"), JOB_PLAN, root, "documents", "doc_id")
    J.run(spark, root, "documents", ["000001", "000003"])
    J.run(spark, root, "documents")
    return root


@query(f"WITH {JOB} SELECT stage, chunk_id, records FROM (" + " UNION ALL ".join(f"SELECT {i} AS stage, c.chunk_id, count({x}.doc_id) AS records FROM c LEFT JOIN {x} ON {x}.chunk_id = c.chunk_id GROUP BY ALL" for i, x in enumerate("kkl")) + ")")
def job_chunks(spark, sf):
    """What the log says of each stage and frozen chunk, those that keep no row too; the last stage's limit is the job's."""
    root = finished_job(spark, sf)
    return J.done(spark, root, J.load(spark, root, "documents")).where(F.col("stage") != J.SEED).select("stage", "chunk_id", "records")


@query(f"WITH {JOB} SELECT doc_id, chunk_id, CASE WHEN lang = 'en' THEN 'home' ELSE lang END AS out, md5(text) AS text_md5 FROM l")
def job_output(spark, sf):
    return J.output(spark, finished_job(spark, sf), "documents").select("doc_id", "chunk_id", "out", F.md5("text").alias("text_md5"))


# --- typed answers ---------------------------------------------------------------------------------------------------------

@query("""WITH r AS (SELECT doc_id, doc_id % 8 AS k, lang FROM documents)
SELECT doc_id, CASE k WHEN 1 THEN 'selected_id: missing' WHEN 2 THEN 'selected_id: one of C1, C2 is expected' WHEN 3 THEN CASE WHEN lang = 'en' THEN NULL ELSE 'ranking[1]: one of C1, C2 is expected' END WHEN 4 THEN 'ranking: a list is expected' WHEN 5 THEN 'not JSON' WHEN 7 THEN 'ranking[0]: a text is expected' END AS problem,
CASE WHEN k IN (0, 6) OR k = 3 AND lang = 'en' THEN 'C1' END AS selected_id, CASE WHEN k = 0 OR k = 3 AND lang = 'en' THEN 2 WHEN k = 6 THEN 0 END::BIGINT AS ranked FROM r""")
def answers_pick(spark, sf):
    """A flat answer with closed lists: each way to be wrong is told by path."""
    d, k = t(spark, sf, "documents"), F.col("doc_id") % 8
    second = F.when(F.col("lang") == "en", "C2").otherwise("C9")
    raw = F.when(k == 0, '{"ranking": ["C1", "C2"], "selected_id": "C1"}').when(k == 1, '{"ranking": []}').when(k == 2, '{"selected_id": "C3"}').when(k == 3, F.concat(F.lit('{"ranking": ["C1", "'), second, F.lit('"], "selected_id": "C1"}')))
    raw = raw.when(k == 4, '{"ranking": "C1", "selected_id": "C1"}').when(k == 5, '{"ranking": ["C1"').when(k == 6, '{"selected_id": "C1", "more": [1]}').otherwise('{"ranking": [1], "selected_id": "C1"}')
    out = AN.typed_answers(d.withColumn("raw", raw), "raw", "TranslationPickById")
    return out.select("doc_id", "problem", "value.selected_id", F.size("value.ranking").cast("long").alias("ranked"))


@query("""SELECT doc_id, CASE WHEN n_chars % 5 = 4 THEN 'issues[0].severity: one of minor, major, serious is expected' WHEN length(text) > 240 THEN 'issues[1].explanation: more than 240 characters' END AS problem,
CASE WHEN n_chars % 5 <> 4 AND length(text) <= 240 THEN length(text)::BIGINT END AS explained FROM documents""")
def answers_gate(spark, sf):
    """A nested answer whose explanations are bounded; every document's whole text is one."""
    d = t(spark, sf, "documents")
    issue = lambda severity, why: F.struct(F.lit("style").alias("category"), F.lit("x").alias("span_in_target"), why.alias("explanation"), severity.alias("severity"))
    issues = F.array(issue(F.when(F.col("n_chars") % 5 == 4, "grave").otherwise("minor"), F.lit("short")), issue(F.lit("major"), F.col("text")))
    raw = F.to_json(F.struct(issues.alias("issues"), F.lit("needs_edit").alias("verdict")))
    out = AN.typed_answers(d.withColumn("raw", raw), "raw", "TranslationGate")
    return out.select("doc_id", "problem", F.length(F.col("value.issues")[1]["explanation"]).cast("long").alias("explained"))


# --- operators, classes and runners over whole tables ----------------------------------------------------------------------

@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_jsonl_whole(spark, sf):
    """Several folders of shards by a list of globs and a pattern of names."""
    path, d = S.scratch(spark, "scan_jsonl"), t(spark, sf, "documents")
    S.write_shards(d.where("doc_id % 2 = 0"), f"{path}/even")
    S.write_shards(d.where("doc_id % 2 = 1"), f"{path}/odd")
    return S.scan(spark, [f"{path}/even", f"{path}/od?"], "doc_id long, text string, lang string, source string, n_chars long", pattern="part-*.json")


@query(f"SELECT doc_id, url + email > 0 OR number <> '' AS bad FROM {MISSES}")
def v_patterns_whole(spark, sf):
    """The validator itself: its failure is the row's."""
    found = Q.validate(pairs(spark, sf), [Q.PatternPreservation(["target_text"], "source_text")])
    return R.fold_errors(found, "check").select("doc_id", F.coalesce("error", F.lit(False)).alias("bad"))


@query(f"SELECT *, CASE WHEN number = '' THEN 0 ELSE len(string_split(number, ',')) END::BIGINT AS numbers FROM {MISSES}")
def pattern_misses_whole(spark, sf):
    """The modifier: counts by kind in a column of the record; and where it counts lost numbers, those themselves."""
    d = R.transfer_check(pairs(spark, sf), "patterns", "lost", "source_text", "target_text")
    count = lambda k: F.coalesce(F.try_element_at("lost", F.lit(k)), F.lit(0)).cast("long")
    d = d.select("doc_id", "source_text", "target_text", *[count(k).alias(n) for k, n in (("url", "url"), ("email", "email"), ("number", "numbers"))])
    lost = F.try_element_at(X.pattern_misses(F.col("source_text"), F.col("target_text"), ("number",)), F.lit("number"))
    return d.select("doc_id", "url", "email", F.when(F.col("numbers") > 0, F.array_join(lost, ",")).otherwise("").alias("number"), "numbers")


@query(f"SELECT doc_id, len(list_filter(issues, lambda i: text = '' OR i.t IS NULL OR i.t = '' OR NOT contains({FOLDED.format(c='text')}, {FOLDED.format(c='i.t')})))::BIGINT AS n FROM {ISSUES}")
def suppress_verbatim_whole(spark, sf):
    """The form that folds case."""
    return issues(spark, sf).select("doc_id", F.size(V.suppress_verbatim(F.col("issues"), F.col("text"), True)).cast("long").alias("n"))


@query(f"""SELECT doc_id, array_to_string(list_transform(list_filter(issues, lambda i: (text = '' OR i.t IS NULL OR i.t = '' OR NOT contains({FOLDED.format(c='text')}, {FOLDED.format(c='i.t')})) AND NOT coalesce(regexp_matches(i.t, '^\\p{{Lu}}'), false)), lambda i: coalesce(i.t, i.r)), ',') AS "left",
array_to_string(list_transform(list_filter(issues, lambda i: NOT coalesce(regexp_matches(i.t, '^\\p{{Lu}}'), false)), lambda i: coalesce(i.t, i.r)), ',') AS alone FROM {ISSUES}""")
def lt_findings_filter_whole(spark, sf):
    """What both filters leave; and, without a reference, what is left where capitals alone count."""
    names = lambda kept: F.array_join(F.transform(kept, lambda i: F.coalesce(i.error_text, i.rule_id)), ",")
    both, alone = V.findings_filter(F.col("issues"), F.col("text")), V.findings_filter(F.col("issues"))
    return issues(spark, sf).select("doc_id", names(both).alias("left"), names(alone).alias("alone"))


def echo(items, feedback):
    """An offline client: it forgets some items at first and answers others twice."""
    for k, text in items.items():
        if int(k) % 10 == 3 and not feedback:
            continue
        for _ in range(2 if int(k) % 10 == 4 else 1):
            yield k, text.upper()


@query("SELECT doc_id, CASE WHEN doc_id % 10 <> 4 THEN upper(lang) END AS out, CASE WHEN doc_id % 10 = 4 THEN true END AS error, CASE WHEN doc_id % 10 = 4 THEN 'batch: more than one answer' END AS error_message FROM documents")
def align_items_whole(spark, sf):
    """Batches of a service: replies are aligned by the id that they echo, and only what failed is sent again."""
    from sievework.operators import services as C

    d = t(spark, sf, "documents").select("doc_id", "lang", F.floor(F.col("doc_id") / 20).alias("chunk_id"))
    return R.fold_errors(C.batched_llm(d, echo, "doc_id", "lang", "out", size=6), "ask").select("doc_id", "out", "error", "error_message")


@query("SELECT doc_id, CASE WHEN n_chars > 500 THEN 'long' ELSE lang END AS out, CASE WHEN n_chars > 500 THEN 'far' ELSE 'near' END AS kind FROM documents")
def plan_diff_whole(spark, sf):
    """The runner: a plan is run, its last stage changed, and the run taken up from there over what is stored."""
    tag = P.Stage("tag", "constants", {"values": {"kind": "near"}})
    route = P.Stage("route", "set_when", {"when": "n_chars > 500", "values": {"route": "long", "kind": "far"}}, service=True)
    last = lambda sources: P.Stage("last", "coalesce", {"target": "out", "sources": sources})
    root, d = S.scratch(spark, "plan"), t(spark, sf, "documents").withColumn("_ord", F.col("doc_id"))
    P.run(spark, P.Plan("p", (tag, route, last(["lang"]))), d, root)
    return P.run(spark, P.Plan("p", (tag, route, last(["route", "lang"]))), d.limit(0), root, start_from="last").select("doc_id", "out", "kind")


@query(f"""SELECT doc_id, CASE WHEN bad THEN true END AS error, CASE WHEN bad THEN 'check' END AS error_stage, CASE WHEN bad THEN 'ResponseValidationError' END AS error_type, CASE WHEN NOT bad THEN 'kept' END AS route FROM (SELECT doc_id, url + email > 0 OR number <> '' OR length(target_text)::DOUBLE / length(source_text) NOT BETWEEN 0.9 AND 1.2 AS bad FROM {MISSES} JOIN {PAIRS} USING (doc_id))""")
def plan_validated(spark, sf):
    """A plan of checks: what they refuse is flagged by its stage, and later stages pass it by."""
    checks = [{"check": "LengthRatio", "fields": ["target_text"], "reference": "source_text", "min_ratio": 0.9, "max_ratio": 1.2}, {"check": "PatternPreservation", "fields": ["target_text"], "reference": "source_text"}]
    plan = P.Plan("checks", (P.Stage("check", "validate", {"checks": checks}), P.Stage("keep", "constants", {"values": {"route": "kept"}})))
    return P.run(spark, plan, pairs(spark, sf).withColumn("_ord", F.col("doc_id")), S.scratch(spark, "plan")).select("doc_id", "error", "error_stage", "error_type", "route")


QUERIES["gated_curation"] = gated_curation
ORACLES["gated_curation"] = FLAGSHIP_SQL
