"""Note validation against notes written by hand."""

import json

from pyspark.sql import functions as F

from glossmark.operators import note_rules as R


def good():
    return {
        "schema_version": "v2", "episode": 1, "date": "2024-01-01", "episode_archetype": {"primary": "philosophy", "secondary": ["interview"]},
        "segment_breakdown": {"market_pct": 50, "qa_pct": 30, "life_or_aside_pct": 10, "ads_pct": 5, "principles_pct": 5},
        "market_regime": {"phase_label": "x", "narrative": "y", "geopolitical_factors": [], "regime_tags": []},
        "host_state": {"disclosed_positions": [], "self_critique": [{"tone": "joke"}], "personal_arc_markers": []},
        "topics": ["a", "b", "c"],
        "investment_logic": [{"claim": "c", "trigger": "t", "is_conditional": True, "condition": None, "action_bias": "buy", "risk_control": "", "risk_control_type": "none", "evidence": "e", "source_type": "s", "confidence": "low"}],
        "catalysts": [{"id": "c1", "event": "e", "expected_date": "d", "category": "earnings", "expected_impact": "i", "linked_assets": []}],
        "trade_observations": [{"asset_or_sector": "a", "asset_symbol": None, "asset_type": "stock", "view": {"short_term": "neutral", "medium_term": "bullish", "long_term": "unstated"}, "primary_horizon": "swing", "reasoning": "r", "industry_nodes": [], "catalyst_anchor": "c1", "consensus_level": "crowded", "market_alignment": "m", "tone": "serious"}],
        "qa_views": [], "narrative_threads": [], "view_changes": [], "principles": [], "mantras_or_catchphrases": [], "warnings": [], "references": [], "non_tradeable_insights": [], "open_questions": [],
    }


def check(spark, notes, rules=R.SECOND_FORMAT):
    rows = spark.createDataFrame([(i, n if isinstance(n, str) else json.dumps(n)) for i, n in enumerate(notes)], "i int, t string")
    found = rows.select("i", R.validate(F.try_parse_json("t"), rules).alias("e")).collect()
    return [r.e for r in sorted(found)]


def test_second_format(spark):
    missing = good()
    del missing["warnings"], missing["date"]
    sums = good()
    sums["segment_breakdown"]["market_pct"] = 62
    wrong_kind = good()
    wrong_kind["segment_breakdown"]["market_pct"] = "50"
    flag = good()
    flag["segment_breakdown"]["market_pct"] = True
    few = good() | {"topics": ["a"], "schema_version": "v1"}
    inner = good()
    inner["investment_logic"][0] |= {"action_bias": "jump", "is_conditional": "yes", "evidence": "x" * 201}
    del inner["investment_logic"][0]["claim"]
    inner["investment_logic"].append("text")
    anchor = good()
    anchor["trade_observations"][0] |= {"catalyst_anchor": "c9", "tone": None}
    tone = good()
    tone["host_state"]["self_critique"] = [{"tone": "loud"}, "text"]
    assert check(spark, [good(), missing, sums, wrong_kind, flag, few, inner, anchor, tone, "not json"]) == [
        [],
        ["missing date", "missing warnings"],
        ["segment_breakdown sum must be near 100, got 112"],
        ["segment_breakdown.market_pct must be int"],
        ["segment_breakdown sum must be near 100, got 51"],
        ["schema_version must be v2", "topics must contain 3-8 items"],
        ["investment_logic[0] missing claim", "investment_logic[0].action_bias invalid: jump", "investment_logic[0].is_conditional must be bool", "investment_logic[0].evidence exceeds 200 chars", "investment_logic[1] must be object"],
        ["trade_observations[0].tone invalid: None", "trade_observations[0].catalyst_anchor missing catalyst: c9"],
        ["host_state.self_critique[0].tone invalid: loud"],
        ["not a JSON object"],
    ]


def test_first_format_and_location(spark):
    note = {"episode": 1, "date": "d", "title": "t", "market_regime": "m", "topics": ["a", "b", "c"], "investment_logic": [], "trade_observations": [], "qa_views": [], "open_questions": []}
    assert check(spark, [note, note | {"episode": "1"}], R.FIRST_FORMAT) == [[], ["episode must be int"]]
    text = json.dumps(note)
    records = [note, {"content": note}, {"note": f"```json\n{text}\n```"}, {"response": {"output_text": text}}, {"body": {"choices": [{"message": {"content": text}}]}}, {"other": 1}]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, t string")
    found = rows.select("i", R.at(R.located(F.try_parse_json("t")), "title").cast("string").alias("title")).collect()
    assert [r.title for r in sorted(found)] == ["t"] * 5 + [None]


def test_repair(spark):
    raw = {"title": "t", "topics": ["a", "b", "c"], "investment_logic": [{"action_bias": " Trim ", "confidence": "高", "evidence": "x" * 300}, {"action_bias": "leap"}, None], "trade_observations": [{"view": "Bull", "time_horizon": "short term", "is_joke_or_aside": "YES"}, {"view": "BEARISH"}], "qa_views": [{"evidence": None}]}
    rows = spark.createDataFrame([(json.dumps(raw),)], "t string").select(F.from_json("t", R.FIRST_SCHEMA).alias("n"))
    n = rows.select(R.repaired(F.col("n"), F.lit(7), F.lit("2024-01-01"), F.lit("other")).alias("n")).first().n
    assert (n.episode, n.date, n.title) == (7, "2024-01-01", "t")
    assert [(x.action_bias, x.confidence, len(x.evidence)) for x in n.investment_logic] == [("size-down", "high", 200), ("unknown", "medium", 0)]
    assert [(x.view, x.time_horizon, x.is_joke_or_aside) for x in n.trade_observations] == [("bullish", "swing", True), ("bearish", "unclear", False)]
    assert n.qa_views[0].evidence == ""
