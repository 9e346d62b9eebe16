"""Validation of structured notes, declared as rules over a Variant column and compiled to one array expression of messages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of a value as schema_of_variant names them; a boolean passes for a number in the notes' own language.
KINDS = {"str": "STRING", "int": "BIGINT|BOOLEAN", "bool": "BOOLEAN", "list": "ARRAY<.*", "dict": "OBJECT<.*"}
EMPTY = "array<string>"


@dataclass(frozen=True)
class Items:
    """What each object of an array must have."""

    path: str
    required: Sequence[str] = ()
    enums: Mapping[str, Sequence[str]] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    longest: Mapping[str, int] = field(default_factory=dict)
    #: field: (array, key) that its value, unless null, must be found under
    refers: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    objects: bool = True


@dataclass(frozen=True)
class Rules:
    required: Sequence[str]
    equal: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    enums: Mapping[str, Sequence[str]] = field(default_factory=dict)
    enum_lists: Mapping[str, Sequence[str]] = field(default_factory=dict)
    sizes: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    #: object: integer fields whose sum must be near 100
    shares: Mapping[str, Sequence[str]] = field(default_factory=dict)
    items: Sequence[Items] = ()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is computed once a row, however often use names it. A Column that is named twice stands in the plan twice, and is
    computed as often wherever that is below a condition or in a lambda; a lambda's own variable is not."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, "$." + path, "variant")


def is_kind(value: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike(f"^({KINDS[kind]})$"), F.lit(False))


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def shown(value: Column) -> Column:
    """As messages write a value: a missing or null one is None."""
    kind = F.schema_of_variant(value)
    return F.when(value.isNull() | (kind == "VOID"), "None").when(kind == "BOOLEAN", F.initcap(text_of(value))).when(kind == "STRING", text_of(value)).otherwise(F.to_json(value))


def _if(condition: Column, message: Column) -> Column:
    return F.when(condition, F.array(message)).otherwise(F.array().cast(EMPTY))


def _one_of(value: Column, allowed: Sequence[str]) -> Column:
    return is_kind(value, "str") & F.coalesce(text_of(value).isin(*allowed), F.lit(False))


def _list(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, "$." + path, "array<variant>"), F.array().cast("array<variant>"))


def _under(key: str):
    return lambda x: shown(at(x, key))


def _bad_entry(path: str, allowed: Sequence[str]):
    return lambda x, i: F.when(~_one_of(x, allowed), F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("] invalid: "), shown(x)))


def _items(note: Column, rule: Items) -> Column:
    def one(item: Column, i: Column) -> Column:
        name = F.concat(F.lit(f"{rule.path}["), i.cast("string"), F.lit("]"))
        said = lambda rest: F.concat(name, F.lit(rest))
        found = [_if(at(item, k).isNull(), said(f" missing {k}")) for k in rule.required]
        found += [_if(~_one_of(at(item, k), v), F.concat(name, F.lit(f".{k} invalid: "), shown(at(item, k)))) for k, v in rule.enums.items()]
        found += [_if(~is_kind(at(item, k), t), said(f".{k} must be {t}")) for k, t in rule.types.items()]
        found += [_if(F.length(shown(at(item, k))) > n, said(f".{k} exceeds {n} chars")) for k, n in rule.longest.items()]
        for k, (path, key) in rule.refers.items():
            known = F.transform(_list(note, path), _under(key))
            given = shown(at(item, k))
            found.append(_if((given != "None") & ~F.array_contains(known, given), F.concat(name, F.lit(f".{k} missing catalyst: "), given)))
        other = F.array(said(" must be object")) if rule.objects else F.array().cast(EMPTY)
        return F.when(is_kind(item, "dict"), F.concat(*found) if found else F.array().cast(EMPTY)).otherwise(other)

    return F.flatten(F.transform(_list(note, rule.path), one))


def validate(note: Column, rules: Rules) -> Column:
    """array<string>: what is wrong with the note, in the rules' order. Missing fields end it, as nothing else can be judged then.

    The note, which may be the parsing of a text, is computed once."""
    return let(note, lambda value: _errors(value, rules))


def _errors(note: Column, rules: Rules) -> Column:
    missing = F.array_compact(F.array(*[F.when(at(note, k).isNull(), F.lit(f"missing {k}")) for k in rules.required]))
    found = [_if(F.coalesce(text_of(at(note, k)) != v, F.lit(True)), F.lit(f"{k} must be {v}")) for k, v in rules.equal.items()]
    found += [_if(~is_kind(at(note, k), t), F.lit(f"{k} must be {t}")) for k, t in rules.types.items()]
    for k, (low, high) in rules.sizes.items():
        found.append(_if(is_kind(at(note, k), "list") & ~F.size(_list(note, k)).between(low, high), F.lit(f"{k} must contain {low}-{high} items")))
    found += [_if(~_one_of(at(note, k), v), F.concat(F.lit(f"{k} invalid: "), shown(at(note, k)))) for k, v in rules.enums.items()]
    for k, allowed in rules.enum_lists.items():
        found.append(F.array_compact(F.transform(_list(note, k), _bad_entry(k, allowed))))
    for k, parts in rules.shares.items():
        values = [at(note, f"{k}.{p}") for p in parts]
        found += [_if(~is_kind(v, "int"), F.lit(f"{k}.{p} must be int")) for p, v in zip(parts, values, strict=True)]
        number = lambda v: F.coalesce(F.try_variant_get(v, "$", "bigint"), F.try_variant_get(v, "$", "boolean").cast("bigint"))
        total = sum((number(v) for v in values), F.lit(0))
        every = F.lit(True)
        for v in values:
            every = every & is_kind(v, "int")
        found.append(_if(every & ~total.between(95, 105), F.concat(F.lit(f"{k} sum must be near 100, got "), total.cast("string"))))
    found += [_items(note, r) for r in rules.items]
    return F.when(note.isNull(), F.array(F.lit("not a JSON object"))).when(F.size(missing) > 0, missing).otherwise(F.concat(*found) if found else missing)


def located(record: Column) -> Column:
    """The note in a batch record (Variant): itself, or below content, note or a response, as an object or as JSON text in a fence.

    The record, which may be the parsing of a text, is computed once, and so is what stands at each place up to the first note."""
    return let(record, _located)


def _located(record: Column) -> Column:
    from glossmark.functions.text import unfenced

    def there(found: Column) -> Column:
        return F.when(is_kind(found, "dict"), found).when(is_kind(found, "str"), let(text_of(found), lambda text: F.try_parse_json(unfenced(text))))

    # fixed values: where a batch record holds its note, the first that is there counts
    paths = ("content", "note", "response.output_text", "body.output_text", "response.choices[0].message.content", "body.choices[0].message.content", "response.output[0].content[0].text")
    below = F.coalesce(*[let(at(record, p), there) for p in paths])
    whole = F.when(at(record, "topics").isNotNull() & at(record, "episode").isNotNull(), record)
    return F.coalesce(whole, below)


# fixed values: vocabularies of the second note format
ARCHETYPES = ["market_commentary", "qa_heavy", "single_stock_deep_dive", "industry_supply_chain", "philosophy", "interview", "event_response", "milestone_or_retrospective", "lifestyle", "cautionary_tale", "business_or_sponsorship"]
ACTIONS = ["buy", "sell", "hold", "hedge", "wait", "size-up", "size-down", "trim", "scale-out", "scale-in", "stop-out", "pyramid", "rotate", "unknown"]
RISK_CONTROLS = ["stop-loss", "position-size", "diversify", "liquidity", "time-bound", "none"]
CONFIDENCES = ["high", "medium", "low"]
ASSET_TYPES = ["stock", "sector", "index", "theme", "crypto", "macro", "commodity"]
VIEWS = ["bullish", "bearish", "neutral", "conditional", "unstated"]
HORIZONS = ["intraday", "swing", "medium-term", "long-term", "unclear"]
CONSENSUS = ["consensus", "contrarian", "crowded", "overlooked", "unclear"]
TONES = ["serious", "self_deprecating", "sarcastic", "warning", "joke", "promotional"]
QUESTIONS = ["investment_operation", "personal_finance", "career", "family", "relationships", "lifestyle", "ethics", "tools_platforms", "health_mental"]
CATALYSTS = ["monetary_policy", "earnings", "macro_data", "regulation", "product_launch", "conference", "election", "black_swan", "IPO_or_listing", "merger_acquisition", "other"]
THREADS = ["originating", "follow_up", "update", "resolution", "aside"]
PRINCIPLES = ["position_sizing", "exit_discipline", "entry_discipline", "risk_management", "sentiment_reading", "contrarian", "longterm_outlook", "mental_health", "lifestyle_balance"]
WARNINGS = ["instrument_trap", "anti_pattern", "rumor_debunk", "scam_alert"]
REFERENCES = ["book", "article", "podcast_or_video", "report", "expert_quote"]
DOMAINS = ["tech_industry", "macro_trend", "society", "personal_finance", "lifestyle", "management"]
LISTS = ["topics", "investment_logic", "trade_observations", "qa_views", "catalysts", "narrative_threads", "view_changes", "principles", "mantras_or_catchphrases", "warnings", "references", "non_tradeable_insights", "open_questions"]

# fixed values: fields and sizes of the second note format
SECOND_FORMAT = Rules(
    required=["schema_version", "episode", "date", "episode_archetype", "segment_breakdown", "market_regime", "host_state", *LISTS],
    equal={"schema_version": "v2"},
    types={"date": "str", **dict.fromkeys(("episode_archetype", "segment_breakdown", "market_regime", "host_state"), "dict"), **dict.fromkeys(LISTS, "list"), "market_regime.phase_label": "str", "market_regime.narrative": "str", **dict.fromkeys(("market_regime.geopolitical_factors", "market_regime.regime_tags", "host_state.disclosed_positions", "host_state.self_critique", "host_state.personal_arc_markers"), "list")},
    sizes={"topics": (3, 8)},
    enums={"episode_archetype.primary": ARCHETYPES},
    enum_lists={"episode_archetype.secondary": ARCHETYPES},
    shares={"segment_breakdown": ("market_pct", "qa_pct", "life_or_aside_pct", "ads_pct", "principles_pct")},
    items=[
        Items("host_state.self_critique", enums={"tone": TONES}, objects=False),
        Items("investment_logic", ["claim", "trigger", "is_conditional", "condition", "action_bias", "risk_control", "risk_control_type", "evidence", "source_type", "confidence"], {"action_bias": ACTIONS, "risk_control_type": RISK_CONTROLS, "confidence": CONFIDENCES}, {"is_conditional": "bool"}, {"evidence": 200}),
        Items("catalysts", ["id", "event", "expected_date", "category", "expected_impact", "linked_assets"], {"category": CATALYSTS}, {"linked_assets": "list"}),
        Items("trade_observations", ["asset_or_sector", "asset_symbol", "asset_type", "view", "primary_horizon", "reasoning", "industry_nodes", "catalyst_anchor", "consensus_level", "market_alignment", "tone"], {"asset_type": ASSET_TYPES, "view.short_term": VIEWS, "view.medium_term": VIEWS, "view.long_term": VIEWS, "primary_horizon": HORIZONS, "consensus_level": CONSENSUS, "tone": TONES}, {"industry_nodes": "list"}, refers={"catalyst_anchor": ("catalysts", "id")}),
        Items("qa_views", ["category", "question_theme", "viewpoint", "principle", "tone", "evidence", "asker_persona"], {"category": QUESTIONS}, longest={"evidence": 200}),
        Items("narrative_threads", enums={"this_episode_role": THREADS}, objects=False),
        Items("principles", enums={"category": PRINCIPLES}, objects=False),
        Items("warnings", enums={"type": WARNINGS}, objects=False),
        Items("references", enums={"type": REFERENCES}, objects=False),
        Items("non_tradeable_insights", enums={"domain": DOMAINS}, objects=False),
    ],
)
# fixed values: fields and vocabularies of the first note format
FIRST_ACTIONS = ["buy", "sell", "hold", "hedge", "wait", "size-down", "rotate", "unknown"]
FIRST_VIEWS = ["bullish", "bearish", "neutral", "conditional"]
FIRST_FORMAT = Rules(
    required=["episode", "date", "title", "market_regime", "topics", "investment_logic", "trade_observations", "qa_views", "open_questions"],
    types={"episode": "int", "date": "str", "title": "str", "market_regime": "str", **dict.fromkeys(["topics", "investment_logic", "trade_observations", "qa_views", "open_questions"], "list")},
    sizes={"topics": (3, 8)},
    items=[
        Items("investment_logic", ["claim", "trigger", "action_bias", "risk_control", "evidence", "confidence"], {"action_bias": FIRST_ACTIONS, "confidence": CONFIDENCES}, longest={"evidence": 200}),
        Items("trade_observations", ["asset_or_sector", "view", "time_horizon", "reasoning", "market_alignment", "is_joke_or_aside"], {"view": FIRST_VIEWS, "time_horizon": HORIZONS}, {"is_joke_or_aside": "bool"}),
        Items("qa_views", ["question_theme", "viewpoint", "principle", "tone", "evidence"], longest={"evidence": 200}),
    ],
)

# fixed values: what notes of the first format write for an action, a view, a horizon and a confidence
ACTION_ALIASES = {"accumulate": "buy", "add": "buy", "buying": "buy", "conditional": "wait", "de-risk": "size-down", "decrease": "size-down", "increase": "buy", "reduce": "size-down", "sell down": "size-down", "size_down": "size-down", "size down": "size-down", "trim": "size-down", "watch": "wait", "watchlist": "wait", "觀望": "wait", "等待": "wait", "買進": "buy", "加碼": "buy", "賣出": "sell", "減碼": "size-down", "避險": "hedge", "輪動": "rotate"}
VIEW_ALIASES = {"positive": "bullish", "bull": "bullish", "buy": "bullish", "negative": "bearish", "bear": "bearish", "sell": "bearish", "hold": "neutral", "wait": "conditional", "mixed": "conditional", "unclear": "neutral", "unknown": "neutral", "看多": "bullish", "偏多": "bullish", "看空": "bearish", "偏空": "bearish", "中性": "neutral", "觀望": "conditional"}
HORIZON_ALIASES = {"short-term": "swing", "short term": "swing", "near-term": "swing", "near term": "swing", "mid-term": "medium-term", "mid term": "medium-term", "medium term": "medium-term", "long term": "long-term", "短線": "swing", "中期": "medium-term", "長期": "long-term"}
CONFIDENCE_ALIASES = {"strong": "high", "certain": "high", "moderate": "medium", "normal": "medium", "weak": "low", "uncertain": "low", "高": "high", "中": "medium", "低": "low"}

FIRST_SCHEMA = """episode int, date string, title string, market_regime string, topics array<string>,
 investment_logic array<struct<claim: string, trigger: string, action_bias: string, risk_control: string, evidence: string, confidence: string>>,
 trade_observations array<struct<asset_or_sector: string, asset_symbol: string, view: string, time_horizon: string, reasoning: string, market_alignment: string, is_joke_or_aside: string>>,
 qa_views array<struct<question_theme: string, viewpoint: string, principle: string, tone: string, evidence: string>>, open_questions array<string>"""


def repaired(note: Column, episode: Column, date: Column, title: Column) -> Column:
    """A note of FIRST_SCHEMA brought to the format: what metadata knows where the note is silent, values to their vocabularies,
    evidence cut at 200 characters, flags as booleans. Entries that are null are left out."""
    from glossmark.operators.notes import bool_value, enum_value, short_evidence

    def logic(x: Column) -> Column:
        x = x.withField("action_bias", enum_value(x["action_bias"], FIRST_ACTIONS, ACTION_ALIASES, "unknown"))
        return x.withField("confidence", enum_value(x["confidence"], CONFIDENCES, CONFIDENCE_ALIASES, "medium")).withField("evidence", F.coalesce(short_evidence(x["evidence"]), F.lit("")))

    def observation(x: Column) -> Column:
        x = x.withField("view", enum_value(x["view"], FIRST_VIEWS, VIEW_ALIASES, "neutral"))
        return x.withField("time_horizon", enum_value(x["time_horizon"], HORIZONS, HORIZON_ALIASES, "unclear")).withField("is_joke_or_aside", bool_value(x["is_joke_or_aside"]))

    def answer(x: Column) -> Column:
        return x.withField("evidence", F.coalesce(short_evidence(x["evidence"]), F.lit("")))

    def fixed(note: Column) -> Column:
        # each field is read from the note as it came: read from one with fields replaced, it would hold that one again, twice for each field
        new = note.withField("episode", F.coalesce(note["episode"], episode)).withField("date", F.coalesce(note["date"], date, F.lit(""))).withField("title", F.coalesce(note["title"], title, F.lit("")))
        for name, fix in (("investment_logic", logic), ("trade_observations", observation), ("qa_views", answer)):
            new = new.withField(name, F.transform(F.array_compact(note[name]), fix))
        return new

    return let(note, fixed)
