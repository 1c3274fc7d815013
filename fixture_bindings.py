"""Maps the given `events` table onto the canonical schemas, for queries, tests and the benchmark.

Event names and parameters follow from the columns of `events`; nothing is invented beside them.
The same expressions feed the DuckDB checks, in `oracle_queries.py`, with the four engine-specific
pieces exchanged.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.context import Ctx, Roles, TierRule
from eventloom.sources.events import EventSource
from eventloom.sources.schema import EVENT_PARAMS

AS_OF = date(2024, 1, 31)
FINALISED_UNTIL = date(2024, 1, 29)

FX_ROLES = Roles(
    exposure="exposure",
    entries=("entry_a", "entry_b"),
    generate="generate",
    select="select",
    save="save",
    save_use="save_use",
    complete_back="complete_back",
    prompt="prompt_click",
    label_adjust="label_adjust",
    description_adjust="description_adjust",
    rate="rate",
    upgrade_popup="upgrade_popup",
    upgrade_confirm="upgrade_confirm",
    upgrade_cancel="upgrade_cancel",
    payment_like="%payment_success%",
    credit="credit_reduce",
    credit_feature="voice_design",
    tts="tts",
    tts_feature_path="/voice/design",
    template_click="template_click",
    generate_success="generate_success",
    path_excluded=("exposure", "page_view"),
    path_excluded_suffix="_bounce",
    path_kept="page_bounce",
)

# The table has about two events per user and day, so tiers need lower cuts than the default.
FX_TIERS = TierRule(days=14, high=1.5, mid=1.2)
FX_LABELS = {"page_bounce": "leaves page", "prompt_click": "clicks prompt", "tts": "speaks"}
FX_TEMPLATES = {"tpl_0": "zh", "tpl_1": "zh", "tpl_2": "en", "tpl_3": "en", "tpl_4": "ja"}


def event_name_sql(finalised: bool) -> str:
    """Name of an event. Finalised data reclassifies some events, so preferring it shows."""
    s = 5 if finalised else 0
    return f"""case
        when event_type='view' and k<{70 - s} and user_id%13<>7 then 'exposure'
        when event_type='view' then 'template_click'
        when event_type='click' and user_id%5=0 then 'prompt_click'
        when event_type='click' and k<{85 - s} then 'generate'
        when event_type='click' then 'prompt_click'
        when event_type='signup' and k<{15 - s} then 'entry_a'
        when event_type='signup' and k<30 then 'entry_b'
        when event_type='signup' and k<45 then 'select'
        when event_type='signup' and k<60 then 'rate'
        when event_type='signup' and k<70 then 'generate_success'
        when event_type='signup' and k<80 then 'label_adjust'
        when event_type='signup' and k<90 then 'description_adjust'
        when event_type='signup' and k<95 then 'page_bounce'
        when event_type='signup' then 'other_bounce'
        when event_type='purchase' and k<{50 - s} then 'save'
        when event_type='purchase' and k<60 then 'save_use'
        when event_type='purchase' and k<70 then 'complete_back'
        when event_type='purchase' and k<80 then 'upgrade_popup'
        when event_type='purchase' and k<87 then 'upgrade_confirm'
        when event_type='purchase' and k<94 then 'upgrade_cancel'
        when event_type='purchase' then 'web_payment_success'
        when event_type='error' and k<{40 - s} then 'tts'
        when event_type='error' and k<85 then 'credit_reduce'
        else 'page_view' end"""


def param_sql(string: str) -> dict[str, str]:
    """Typed parameter values by column; `string` is the engine's text type."""
    return {
        "session_id": "cast(event_date as bigint)",
        "template_id": f"case when event_name='template_click' then concat('tpl_', cast(k%6 as {string})) end",
        "action": "case when event_name='rate' and k%3=0 then 1 when event_name='rate' and k%3=1 then 2 end",
        "credit_type": "case when event_name='credit_reduce' then"
        " case when k%2=0 then 'voice_design' else 'tts' end end",
        "credits_int": "case when event_name='credit_reduce' and k%3=0 then cast(floor(value) as bigint) end",
        "credits_double": "case when event_name='credit_reduce' and k%3=1 then value end",
        "credits_string": "case when event_name='credit_reduce' and k%3=2 then"
        f" case when k%5=0 then 'n/a' else cast(value as {string}) end end",
        "from_path": "case when event_name='tts' then case when k%2=0 then '/voice/design' else '/voice/tts' end end",
        "from_cache": "case when event_name='generate_success' then"
        " case when k%2=0 then 'true' else 'false' end end",
        "voice_id": f"case when event_name='save' and k%4<>0 then concat('v', cast(k%7 as {string})) end",
    }


# parameter key, slots and the columns of `param_sql` that fill them
PARAMS = (
    ("ga_session_id", {"int_value": "session_id"}),
    ("templateId", {"string_value": "template_id"}),
    ("action", {"int_value": "action"}),
    ("type", {"string_value": "credit_type"}),
    ("credits", {"int_value": "credits_int", "double_value": "credits_double", "string_value": "credits_string"}),
    ("from", {"string_value": "from_path"}),
    ("from_cache", {"string_value": "from_cache"}),
    ("voice_id", {"string_value": "voice_id"}),
)

# ts carries no zone: take its micros from the calendar fields, whatever the session zone is.
MICROS = (
    "cast(datediff(cast(ts as date), date'1970-01-01') as bigint) * 86400000000L"
    " + hour(ts) * 3600000000L + minute(ts) * 60000000L + cast(extract(second from ts) * 1000000 as bigint)"
)


def _param(key: str, slots: dict[str, str]) -> str:
    columns = param_sql("string")
    value = ", ".join(
        f"'{slot}', cast({columns.get(slots.get(slot), 'null')} as {kind})"
        for slot, kind in (("string_value", "string"), ("int_value", "bigint"), ("double_value", "double"))
    )
    present = " or ".join(f"{columns[column]} is not null" for column in slots.values())
    return f"if({present}, named_struct('key', '{key}', 'value', named_struct({value})), null)"


def _canonical(events: DataFrame, finalised: bool) -> DataFrame:
    """Canonical columns and `ts`, by which days are filtered."""
    fields = events.selectExpr(
        "ts",
        "cast(user_id as string) user_pseudo_id",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') as bigint) k",
        "date_format(ts, 'yyyyMMdd') event_date",
        f"{MICROS} event_timestamp",
    )
    # A generator, unlike a projection, keeps the long CASE out of every filter on the name.
    named = fields.selectExpr("*", f"explode(array({event_name_sql(finalised)})) event_name")
    bag = "array_compact(array(" + ", ".join(_param(k, s) for k, s in PARAMS) + "))"
    return named.select(
        "ts",
        "user_pseudo_id",
        "event_name",
        "event_timestamp",
        F.expr(bag).cast(EVENT_PARAMS).alias("event_params"),
        "event_date",
    )


def _ts_between(lo: date | None, hi: date | None):
    """Bounds on the stored column, so that they reach the Parquet scan."""
    bounds = []
    if lo is not None:
        bounds.append(F.col("ts") >= F.lit(f"{lo} 00:00:00").cast("timestamp_ntz"))
    if hi is not None:
        bounds.append(F.col("ts") < F.lit(f"{hi} 00:00:00").cast("timestamp_ntz"))
    return bounds


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def fx_context(spark: SparkSession, sf_dir: str, as_of: date = AS_OF) -> Ctx:
    """Intraday holds every row; finalised holds every row of the days before FINALISED_UNTIL."""
    events = _events(spark, sf_dir)
    return Ctx(
        intraday=EventSource(_canonical(events, False), _ts_between),
        daily=EventSource(
            _canonical(events, True),
            lambda lo, hi: _ts_between(lo, FINALISED_UNTIL if hi is None else min(hi, FINALISED_UNTIL)),
        ),
        as_of=as_of,
        roles=FX_ROLES,
        tier_rule=FX_TIERS,
    )


TEXT_SQL = """case
    when event_type in ('view','click') then case k%4
        when 0 then '[😨 #Fear:7]: hello'
        when 1 then '[😀 #Happy:5]: hello [😀 #Happy:2]: again'
        when 2 then '[😡 #Anger:9]: hello'
        else '[😢 #Sadness:4]: hello [😨 #Fear:1]: there' end
    when event_type in ('signup','purchase') then case k%8
        when 0 then '[surprise#Fear:2;Anger:3;Happy:4]: hi' when 1 then '[excited#Happy:6;Anger:1]: hi'
        when 2 then '[dramatic#Anger:2;Sadness:5]: hi' when 3 then '[proud#Happy:3]: hi'
        when 4 then '[empathetic#Sadness:2;Happy:1]: hi'
        when 5 then '[curious#Happy:2;Fear:1]: hi [😀 #Happy:2]: mix'
        when 6 then '[frustrated#Anger:4;Sadness:1]: hi' else '[envious#Anger:2;Sadness:2]: hi' end
    when k<50 then '[custom#Fear:1]: hi'
    else 'no tag' end"""


def fx_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).selectExpr("*", "cast(get_json_object(props, '$.k') as bigint) k")
    return events.selectExpr(
        "event_id gen_product_id",
        f"{TEXT_SQL} target_text",
        "value > 20 is_downloaded",
        "case when k%10=0 then ts end deleted_at",
        "ts created_at",
    )
