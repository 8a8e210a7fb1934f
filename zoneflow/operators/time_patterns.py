"""Time-of-day factors per zone type: slots, lookup, expected rates and config checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.defaults import TimePatterns
from zoneflow.functions.time import day_type, local_time

DAY_TYPES = ("weekday", "weekend")
AVAILABLE_SHARE = 0.75  # fixed value: share of driver updates that report an available driver


def time_slots(patterns: DataFrame) -> DataFrame:
    """One row per (day type, hour, zone type) with the factors that hold there.

    The first pattern that covers a (day type, hour) owns it: a zone type that pattern lacks gets no
    row, even where a later pattern has one. That leaves at most 48 owners.
    """
    owners = (
        patterns.select("pattern_index", "pattern_id", "day_type", "zone_type_multipliers",
                        F.explode("hours").alias("hour"))
        .where(F.col("day_type").isin(*DAY_TYPES) & F.col("hour").between(0, 23))
        .groupBy("day_type", "hour")
        .agg(F.min_by(F.struct("pattern_id", "zone_type_multipliers"), "pattern_index").alias("owner"))
    )
    return owners.select(
        "day_type", "hour", F.col("owner.pattern_id").alias("pattern_id"),
        F.explode("owner.zone_type_multipliers").alias("type", "factors"),
    ).select("day_type", "hour", "type", "pattern_id", "factors.demand_factor", "factors.supply_factor")


def enrich_with_time_factors(df: DataFrame, config: TimePatterns, time: str = "event_time",
                             zone_type: str = "type", tz: str | None = None) -> DataFrame:
    """Add ``day_type``, ``hour``, ``demand_factor`` and ``supply_factor`` to every row.

    An equi-join on (day type, hour, zone type) with the slots, which are derived from a config
    file: Catalyst sees their size and broadcasts them. What finds no slot gets the defaults.
    """
    local = local_time(F.col(time), tz)
    slots = time_slots(config.patterns).drop("pattern_id").withColumnRenamed("type", "_type")
    keyed = df.withColumns({"day_type": day_type(local), "hour": F.hour(local)})
    joined = keyed.join(
        slots.withColumnsRenamed({"day_type": "_day_type", "hour": "_hour"}),
        (F.col("day_type") == F.col("_day_type")) & (F.col("hour") == F.col("_hour"))
        & (F.col(zone_type) == F.col("_type")),
        "left",
    )
    return joined.withColumns({
        "demand_factor": F.coalesce("demand_factor", F.lit(config.default.demand_factor)),
        "supply_factor": F.coalesce("supply_factor", F.lit(config.default.supply_factor)),
    }).select(*keyed.columns, "demand_factor", "supply_factor")


def expected_rates(zone_ticks: DataFrame) -> DataFrame:
    """Expected requests, driver updates, available drivers and generosity of enriched zone ticks."""
    updates = F.greatest(F.lit(1), (F.col("base_supply") * F.col("supply_factor")).cast("int"))
    return zone_ticks.withColumns({
        "expected_requests": F.col("base_demand") * F.col("demand_factor"),
        "expected_driver_updates": updates,
        "expected_available": updates * F.lit(AVAILABLE_SHARE),
        "generosity_center": 1 / (1 + F.col("price_sensitivity")),
    })


def pattern_violations(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Every broken rule of time-pattern configs, one JSON document per row.

    Returns (key, pattern_index, rule, detail); ``pattern_index`` is NULL for rules on the whole
    document. Values are read as variants, so a wrong type is seen instead of turned into NULL.
    All rules of a level are checked by narrow expressions; nothing is shuffled.
    """
    parsed = documents.select(key, F.try_parse_json(F.col(text)).alias("doc")).select(
        key,
        _is_object("doc").alias("is_object"),
        _get("doc", "time_patterns").alias("listed"),
        _get("doc", "default").alias("default"),
    )
    listed = parsed.select(key, "is_object", "default", _items("listed").alias("patterns"))
    checked = listed.select(
        key,
        F.col("patterns"),
        _found(
            _rule(~F.col("is_object"), "config_not_object"),
            _rule(F.col("is_object") & ~_holds(F.size("patterns") > 0), "patterns_not_list"),
            *_factor_rules(F.col("default"), F.lit("default"), F.col("default").isNotNull()),
        ).alias("doc_rules"),
    )
    each = checked.select(key, "doc_rules", F.posexplode_outer("patterns").alias("pattern_index", "pattern"))
    fields = each.select(
        key, "doc_rules", "pattern_index",
        (F.col("pattern_index").isNotNull() & ~_is_object("pattern")).alias("no_object"),
        _is_object("pattern").alias("is_object"),
        *[_get("pattern", name).alias(name) for name in _FIELDS],
    )
    typed = fields.select(
        key, "doc_rules", "pattern_index", "no_object", "is_object",
        *[F.col(name).isNotNull().alias(f"has_{name}") for name in _FIELDS],
        _text("pattern_id").alias("pattern_id"),
        _text("day_type").alias("day_type"),
        _items("hours").alias("hours"),
        F.map_entries(_map(F.col("zone_type_multipliers"))).alias("factors"),
    )
    # rules on the whole document are reported once, with its first pattern
    first = F.coalesce(F.col("pattern_index"), F.lit(0)) == 0
    found = typed.select(key, F.explode(F.concat(
        F.when(first, _at(F.lit(None), F.col("doc_rules"))).otherwise(F.array()),
        _at(F.col("pattern_index"), _pattern_rules()),
    )).alias("found"))
    return found.select(key, "found.pattern_index", "found.rule", "found.detail")


def require_valid(documents: DataFrame, key: str, text: str) -> None:
    """Raise ``ValueError`` if rules are broken, with the number of violations and some of them."""
    violations = pattern_violations(documents, key, text)
    broken = violations.limit(10).collect()
    if broken:
        raise ValueError(f"{violations.count()} violations, among them: " + "; ".join(
            f"{row[0]}: pattern {row.pattern_index}: {row.rule} {row.detail or ''}".strip() for row in broken
        ))


def _pattern_rules() -> Column:
    """Broken rules of one pattern; a value of the wrong type is NULL, though its field is there."""
    is_object = F.col("is_object")
    has = {name: is_object & F.col(f"has_{name}") for name in _FIELDS}
    rules = _found(
        _rule(F.col("no_object"), "pattern_not_object"),
        *[_rule(is_object & ~F.col(f"has_{name}"), "missing_field", F.lit(name)) for name in _FIELDS],
        _rule(has["pattern_id"] & ~_holds(F.length("pattern_id") > 0), "pattern_id_not_text"),
        _rule(has["day_type"] & ~_holds(F.col("day_type").isin(*DAY_TYPES)), "unknown_day_type", F.col("day_type")),
        _rule(has["hours"] & ~_holds(F.size("hours") > 0), "hours_not_list"),
        _rule(has["zone_type_multipliers"] & ~_holds(F.size("factors") > 0), "multipliers_not_object"),
    )
    bad_hours = F.transform(
        F.filter("hours", lambda hour: ~_holds(
            (_kind(hour) == "BIGINT") & F.try_variant_get(hour, "$", "long").between(0, 23))),
        lambda hour: _violation("invalid_hour", F.to_json(hour)),
    )
    bad_factors = F.flatten(F.transform("factors", lambda entry: _found(
        _rule(F.length(entry["key"]) < 1, "empty_zone_type"),
        *_factor_rules(entry["value"], entry["key"], F.lit(True)),
    )))
    return F.concat(rules, F.coalesce(bad_hours, F.array()), F.coalesce(bad_factors, F.array()))


_FIELDS = ("pattern_id", "day_type", "hours", "zone_type_multipliers")


def _factor_rules(value: Column, context: Column, applies: Column) -> list[Column]:
    is_object = _map(value).isNotNull()
    rules = [_rule(applies & ~is_object, "factors_not_object", context)]
    for name in ("demand_factor", "supply_factor"):
        factor = F.try_variant_get(value, f"$.{name}", "variant")
        positive = _is_number(_kind(factor)) & (F.try_variant_get(factor, "$", "double") > 0)
        rules.append(_rule(applies & is_object & ~_holds(positive), "factor_not_positive",
                           F.concat(context, F.lit(f".{name}"))))
    return rules


def _kind(value: Column) -> Column:
    """Type name of a scalar variant."""
    return F.schema_of_variant(value)


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def _map(value: Column) -> Column:
    """Fields of an object; NULL for any other value."""
    return F.try_variant_get(value, "$", "map<string, variant>")


def _is_object(column: str) -> Column:
    return _map(F.col(column)).isNotNull()


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _get(column: str, name: str) -> Column:
    return F.try_variant_get(F.col(column), f"$.{name}", "variant")


def _text(column: str) -> Column:
    return F.when(_kind(F.col(column)) == "STRING", F.try_variant_get(F.col(column), "$", "string"))


def _items(column: str) -> Column:
    return F.try_variant_get(F.col(column), "$", "array<variant>")


def _violation(rule: str, detail: Column | None = None) -> Column:
    detail = F.lit(None) if detail is None else detail
    return F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def _rule(broken: Column, rule: str, detail: Column | None = None) -> Column:
    return F.when(_holds(broken), _violation(rule, detail))


def _found(*rules: Column) -> Column:
    return F.filter(F.array(*rules), lambda rule: rule.isNotNull())


def _at(index: Column, violations: Column) -> Column:
    """Violations with the position of their pattern."""
    return F.transform(violations, lambda v: F.struct(
        index.cast("int").alias("pattern_index"), v["rule"].alias("rule"), v["detail"].alias("detail")))
