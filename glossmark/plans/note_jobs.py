"""Queries over note jobs: notes of both formats made from the documents, in the envelopes of batch services, brought to counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossmark.operators import note_jobs as J
from glossmark.operators import note_rules
from glossmark.plans import records
from glossmark.plans.tables import table
from glossmark.registry import register


def _k() -> Column:
    return F.col("doc_id")


def _pick(*values: str, by: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (by % len(values) + 1).cast("int"))


def second_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, note): a note of the second format for each document, as JSON text; some break its rules."""
    nothing = F.array().cast("array<string>")
    t = lambda name: F.lit("x").alias(name)
    tone = F.when(F.col("lang") == "en", "joke").otherwise("glad")
    logic = F.struct(
        t("claim"), t("trigger"), (_k() % 2 == 0).alias("is_conditional"), t("condition"), _pick("trim", "buy", "jump", by=_k()).alias("action_bias"), t("risk_control"),
        F.lit("stop-loss").alias("risk_control_type"), F.col("text").alias("evidence"), t("source_type"), F.lit("low").alias("confidence"),
    )
    catalyst = F.struct(F.lit("c0").alias("id"), t("event"), t("expected_date"), F.lit("earnings").alias("category"), t("expected_impact"), F.when(_k() % 9 != 0, nothing).alias("linked_assets"))
    view = F.struct(F.lit("bullish").alias("short_term"), _pick("neutral", "sideways", by=_k()).alias("medium_term"), F.lit("unstated").alias("long_term"))
    seen = F.struct(
        F.col("source").alias("asset_or_sector"), t("asset_symbol"), F.lit("stock").alias("asset_type"), view.alias("view"), F.lit("swing").alias("primary_horizon"), t("reasoning"), nothing.alias("industry_nodes"),
        _pick("c0", "c1", "c0", by=_k()).alias("catalyst_anchor"), F.lit("crowded").alias("consensus_level"), t("market_alignment"), F.lit("serious").alias("tone"),
    )
    shares = F.struct((F.lit(60) + _k() % 13).alias("market_pct"), F.lit(20).alias("qa_pct"), F.lit(10).alias("life_or_aside_pct"), F.lit(5).alias("ads_pct"), F.lit(0).alias("principles_pct"))
    lists = {name: nothing for name in note_rules.LISTS} | {"topics": F.array_repeat(F.lit("t"), (_k() % 10).cast("int")), "investment_logic": F.array(logic), "catalysts": F.array(catalyst), "trade_observations": F.array(seen)}
    note = F.struct(
        F.when(_k() % 11 == 0, "v1").otherwise("v2").alias("schema_version"), F.when(_k() % 7 != 0, _k()).alias("episode"), F.lit("2024-01-01").alias("date"),
        F.struct(_pick("qa_heavy", "interview", "chat", by=_k()).alias("primary"), F.array(F.lit("interview"), _pick("milestone", "lifestyle", by=_k())).alias("secondary")).alias("episode_archetype"),
        shares.alias("segment_breakdown"),
        F.struct(t("phase_label"), t("narrative"), nothing.alias("geopolitical_factors"), nothing.alias("regime_tags")).alias("market_regime"),
        F.struct(nothing.alias("disclosed_positions"), F.array(F.struct(tone.alias("tone"))).alias("self_critique"), nothing.alias("personal_arc_markers")).alias("host_state"),
        *[c.alias(n) for n, c in lists.items()],
    )
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.to_json(note).alias("note"))


def _second_errors(cut: bool = False) -> str:
    """The messages of a document's second note; cut to their rules, as totals count them."""
    at, bad = ("[]", lambda said, value: said) if cut else ("[0]", lambda said, value: f"{said}{value}")
    second = "[]" if cut else "[1]"
    total = "'segment_breakdown sum must be near 100, got'" if cut else "'segment_breakdown sum must be near 100, got ' || (95 + doc_id % 13)"
    return f"""CASE WHEN doc_id % 7 = 0 THEN 'missing episode' ELSE concat_ws('; ', CASE WHEN doc_id % 11 = 0 THEN 'schema_version must be v2' END, CASE WHEN doc_id % 10 NOT BETWEEN 3 AND 8 THEN 'topics must contain 3-8 items' END,
 CASE WHEN doc_id % 3 = 2 THEN '{bad("episode_archetype.primary invalid", ": chat")}' END, CASE WHEN doc_id % 2 = 0 THEN 'episode_archetype.secondary{second} {bad("invalid", ": milestone")}' END,
 CASE WHEN doc_id % 13 > 10 THEN {total} END, CASE WHEN lang IS DISTINCT FROM 'en' THEN 'host_state.self_critique{at}.tone {bad("invalid", ": glad")}' END,
 CASE WHEN text IS NULL THEN 'investment_logic{at} missing evidence' END, CASE WHEN doc_id % 3 = 2 THEN 'investment_logic{at}.action_bias {bad("invalid", ": jump")}' END, CASE WHEN length(text) > 200 THEN 'investment_logic{at}.evidence exceeds 200 chars' END,
 CASE WHEN doc_id % 9 = 0 THEN 'catalysts{at} missing linked_assets; catalysts{at}.linked_assets must be list' END, CASE WHEN doc_id % 2 = 1 THEN 'trade_observations{at}.view.medium_term {bad("invalid", ": sideways")}' END,
 CASE WHEN doc_id % 3 = 1 THEN 'trade_observations{at}.catalyst_anchor {bad("missing catalyst", ": c1")}' END) END"""


@register("note_errors_second", f"SELECT doc_id, {_second_errors()} AS errors FROM documents")
def note_errors_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with notes of the second format."""
    return second_notes(spark, sf_dir).select("doc_id", F.array_join(note_rules.validate(F.try_parse_json("note"), note_rules.SECOND_FORMAT), "; ").alias("errors"))


def second_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, attempt, record): a run whose every fourth output is an error, and a run of every eighth document again, whose notes lie deeper."""
    notes = second_notes(spark, sf_dir)
    whole = F.concat(F.lit('{"note": '), F.col("note"), F.lit("}"))
    deep = F.concat(F.lit('{"response": {"choices": [{"message": {"content": '), F.col("note"), F.lit("}}]}}"))
    first = notes.select("doc_id", F.lit(0).alias("attempt"), F.when(_k() % 4 != 0, whole).otherwise('{"error": "none"}').alias("record"))
    return first.unionByName(notes.where(_k() % 8 == 0).select("doc_id", F.lit(1).alias("attempt"), deep.alias("record")))


_FIRST = "CASE WHEN doc_id % 7 = 0 THEN 'missing episode' ELSE CASE WHEN doc_id % 10 NOT BETWEEN 3 AND 8 THEN 'topics must contain 3-8 items' ELSE '' END END"
_LOST = "doc_id % 5 = 4 OR doc_id % 35 = 0"


def _jobs_sql(cut: bool = False) -> str:
    return f"""SELECT form, doc_id, CASE WHEN lost THEN 'missing' WHEN e = '' THEN 'valid' ELSE 'invalid' END AS status, CASE WHEN lost OR e = '' THEN 0 ELSE len(string_split(e, '; ')) END::INT AS n_errors, CASE WHEN lost THEN '' ELSE e END AS errors
 FROM (SELECT 'first' AS form, doc_id, {_LOST} AS lost, {_FIRST} AS e FROM documents UNION ALL SELECT 'second', doc_id, doc_id % 4 = 0 AND doc_id % 8 <> 0, {_second_errors(cut)} FROM documents)"""


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both formats' jobs over all documents: (form, doc_id, status, n_errors, errors)."""
    targets = table(spark, sf_dir, "documents").select("doc_id")
    first = records.enveloped(spark, sf_dir).withColumn("attempt", F.lit(0))
    form = J.first_format(F.col("source"))
    done = J.job(targets, first, "doc_id", ["attempt"], "record", form).withColumn("form", F.lit(form.name))
    second = J.job(targets, second_outputs(spark, sf_dir), "doc_id", ["attempt"], "record", J.SECOND).withColumn("form", F.lit(J.SECOND.name))
    return done.unionByName(second)


@register("note_jobs", _jobs_sql())
def note_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's note in both formats after its runs: located in its envelope, repaired, checked, settled."""
    return _jobs(spark, sf_dir).withColumn("errors", F.array_join("errors", "; "))


@register(
    "note_job_totals",
    f"""WITH j AS ({_jobs_sql(cut=True)}), t AS (SELECT form, count(*) AS target, count_if(status = 'valid')::BIGINT AS valid, count_if(status = 'missing')::BIGINT AS missing, count_if(status = 'invalid')::BIGINT AS invalid FROM j GROUP BY form),
 r AS (SELECT form, rule, count(DISTINCT doc_id) AS notes FROM (SELECT form, doc_id, unnest(string_split(errors, '; ')) AS rule FROM j) WHERE rule <> '' GROUP BY ALL)
SELECT form, target, valid, missing, invalid, rule, notes FROM t LEFT JOIN r USING (form)""",
)
def note_job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets, valid, missing and invalid notes of each format, and how many notes break each rule of it."""
    return J.totals(_jobs(spark, sf_dir), "form")


_REQUEST = """'{"custom_id":"' || doc_id || '","prompt":' || to_json(source || ': ' || coalesce(text, '')) || '}'"""


@register(
    "note_requests",
    f"""WITH v AS (SELECT doc_id FROM ({_jobs_sql()}) WHERE form = 'first' AND status = 'valid'), l AS (SELECT doc_id, strlen({_REQUEST}) + 1 AS size FROM documents ANTI JOIN v USING (doc_id)), m AS (SELECT max(size) AS longest FROM l)
SELECT doc_id, size - 1 AS bytes, ((sum(size) OVER (ORDER BY doc_id) - size) // (1000000 - longest + 1))::BIGINT AS batch FROM l, m""",
)
def note_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is asked for next: documents without a valid note of the first format, in request files below a million bytes."""
    docs = table(spark, sf_dir, "documents")
    first = records.enveloped(spark, sf_dir).withColumn("attempt", F.lit(0))
    valid = J.job(docs.select("doc_id"), first, "doc_id", ["attempt"], "record", J.first_format(F.col("source"))).where("status = 'valid'")
    prompt = F.concat(F.col("source"), F.lit(": "), F.coalesce("text", F.lit("")))
    return J.prepare(docs, valid, "doc_id", prompt, 1_000_000, "plain").select("doc_id", F.octet_length("value").cast("long").alias("bytes"), "batch")
