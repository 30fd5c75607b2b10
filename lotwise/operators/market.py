"""Market view, option lists and matching offers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise import vocab as V
from lotwise.functions.text import display_name, strip, title_without_brand
from lotwise.operators.columns import fill_absent, lower_names
from lotwise.operators.dedup import top_rows
from lotwise.operators.medians import grouped_median
from lotwise.operators.ranking import with_ordinal
from lotwise.session import scratch_path
from lotwise.sources.store import write_table

# ---------------------------------------------------------------- market view


def _left(base: DataFrame, child: DataFrame, suffix: str) -> DataFrame:
    """Left join on the listing id; right columns that clash get a suffix."""
    child = lower_names(child).withColumnsRenamed(dict([V.MISSPELT_FEATURE]))
    taken = set(base.columns)
    renamed = {c: f"{c}{suffix}" for c in child.columns if c in taken and c != "listing_id"}
    child = child.withColumnsRenamed(renamed).withColumnRenamed("listing_id", "__lid")
    return base.join(child, base["id"] == child["__lid"], "left").drop("__lid")


def market_view(
    market: str, listings: DataFrame, details: DataFrame | None = None, features: DataFrame | None = None
) -> DataFrame:
    """Listings of one market with their details; absent child tables just add no columns."""
    market = market.upper()
    base = lower_names(listings).where(F.col("market") == market)
    base = base.withColumns({c: strip(F.lower(c)) for c in ("brand", "model")})
    if market == "DE":
        view = base if details is None else _left(base, details, "_de")
        view = view if features is None else _left(view, features, "_feat")
        if "title" not in view.columns:
            view = view.withColumn("title", F.concat_ws(" ", display_name(F.col("brand")), display_name(F.col("model"))))
    else:
        view = base if details is None else _left(base, details, "_us")
        trim = F.nullif(strip(F.col("trim")), F.lit("")) if "trim" in view.columns else F.lit(None)
        view = view.withColumn(
            "title", F.concat_ws(" ", display_name(F.col("brand")), display_name(F.col("model")), trim)
        )
    return fill_absent(view, V.VIEW_COLUMNS, "")


# ---------------------------------------------------------------- option lists
# Lists come as rows, not as arrays: one brand or model may own a third of the market, and its values
# need not fit into one row. ``distinct`` runs before the shuffle as well as after it, and ``ordinal`` is a value's
# place in its sorted list.


def brand_options(view: DataFrame) -> DataFrame:
    return with_ordinal(view.select("brand").where(F.col("brand").isNotNull()).distinct(), [], ["brand"])


def model_options(view: DataFrame) -> DataFrame:
    """Models per brand; brands without a named model get the models of the static table, or ``unknown``."""
    models = view.select("brand", "model").where(F.col("brand").isNotNull() & F.col("model").isNotNull()).distinct()
    named = models.select("brand").distinct()
    static = view.sparkSession.createDataFrame(
        [(b, m) for b, ms in V.BRAND_MODELS.items() for m in ms], "brand string, model string"
    )
    seen = view.select("brand").where(F.col("brand").isNotNull()).distinct()
    others = static.select("brand").distinct()
    unknown = seen.join(named, "brand", "left_anti").join(others, "brand", "left_anti").withColumn("model", F.lit("unknown"))
    return with_ordinal(
        models.unionByName(static.join(named, "brand", "left_anti")).unionByName(unknown), ["brand"], ["model"]
    )


def trim_options(view: DataFrame) -> DataFrame:
    """Trims per brand and model, derived from titles; the "all" entry comes first, with ordinal 0."""
    trim = title_without_brand(F.col("title"), F.col("brand"))
    sorted_ = with_ordinal(
        view.select("brand", "model", trim.alias("option")).where(F.col("option") != "").distinct(),
        ["brand", "model"], ["option"],
    )
    first = view.select("brand", "model").distinct()
    return first.select("*", F.lit(V.ALL_TRIMS).alias("option"), F.lit(0).cast("bigint").alias("ordinal")).unionByName(sorted_)


def location_options(matches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    kept = F.col("location").isNotNull() & ~F.col("location").isin("", "nan")
    return with_ordinal(matches.where(kept).select(*by, "location").distinct(), by, ["location"])


def default_power(view: DataFrame) -> DataFrame:
    """Median power per brand, model and trim, cut to a whole number, 150 when there is none."""
    named = F.col("title").isNotNull() & F.col("brand").isNotNull() & F.col("model").isNotNull()
    keyed = view.where(named).select(
        "brand", "model",
        F.lower(title_without_brand(F.col("title"), F.col("brand"))).alias("trim"),
        F.when(F.col("power_ps") > 0, F.col("power_ps")).alias("power"),
    )
    keys = ["brand", "model", "trim"]
    medians = grouped_median(keyed, keys, "power", "power_ps", keep_empty=True)
    return medians.select(*keys, F.coalesce(F.col("power_ps").cast("int"), F.lit(V.DEFAULT_POWER_PS)).alias("power_ps"))


def refined_options(
    view: DataFrame, subjects: DataFrame,
    columns: Sequence[str] = ("trim", "engine", "exterior_color", "interior_color"),
    fallback: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Option values per subject ``(subject_id, brand, model, fuel, cylinders)``.

    Fuel narrows the model's offers only if something is left, then cylinders narrow what is left by
    the same rule. Instead of looking at all offers of a subject together, each value keeps whether it
    was seen with the fuel, the cylinders, or both; the rule is then applied to these flags.
    """
    wanted = subjects.select(
        "subject_id", "brand", "model",
        F.lower("fuel").alias("__fuel"), F.col("cylinders").cast("double").alias("__cyl"),
    )
    wanted = wanted.withColumn("__asked", F.to_json(F.struct("brand", "model", "__fuel", "__cyl")))
    # both sides shrink to distinct combinations first: however many subjects ask for a hot model and
    # however many offers it has, only different questions meet different answers
    questions = wanted.drop("subject_id").distinct()
    offers = view.select(
        "brand", "model", F.lower("fuel").alias("__f"), F.col("cylinders").cast("double").alias("__c"), *columns
    ).distinct()
    seen = questions.join(offers, ["brand", "model"]).select(
        "__asked",
        F.coalesce(F.col("__f") == F.col("__fuel"), F.lit(False)).alias("f"),
        F.coalesce(F.col("__c") == F.col("__cyl"), F.lit(False)).alias("c"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("option")) for c in columns])
        ).alias("o"),
    )
    flags = seen.groupBy("__asked", "o.field", "o.option").agg(
        F.max("f").alias("f"), F.max("c").alias("c"), F.max(F.col("f") & F.col("c")).alias("fc")
    )
    question = flags.groupBy("__asked").agg(
        F.max("f").alias("any_f"), F.max("c").alias("any_c"), F.max("fc").alias("any_fc")
    )
    keep = (
        F.when(F.col("any_fc"), F.col("fc"))
        .when(F.col("any_f"), F.col("f"))
        .when(F.col("any_c"), F.col("c"))
        .otherwise(F.lit(True))
    )
    answers = (
        flags.join(question, "__asked").where(keep)
        .where(F.col("option").isNotNull() & ~F.col("option").isin("", "nan"))
        .select("__asked", "field", "option")
    )
    found = wanted.select("subject_id", "__asked").join(answers, "__asked").drop("__asked")
    fields = F.explode(F.array(*map(F.lit, columns)))
    asked = subjects.select("subject_id", "brand", "model", fields.alias("field"))
    missing = asked.join(found.select("subject_id", "field").distinct(), ["subject_id", "field"], "left_anti")
    # the model's categories stand in only when there is no offer of this model at all
    known = view.select("brand", "model").distinct().withColumn("__known", F.lit(True))
    defaults = {c: list((fallback or {}).get(c, ["unknown"])) for c in columns}
    table = F.create_map(*[x for c, v in defaults.items() for x in (F.lit(c), F.array(*map(F.lit, v)))])
    rest = missing.join(known, ["brand", "model"], "left").select(
        "subject_id", "field",
        F.explode(
            F.when(F.col("__known"), F.array(F.lit("unknown"))).otherwise(F.try_element_at(table, F.col("field")))
        ).alias("option"),
    )
    return found.unionByName(rest)


def sorted_options(options: DataFrame, by: Sequence[str] = ("subject_id", "field")) -> DataFrame:
    """Option rows with their place in the sorted list they belong to."""
    return with_ordinal(options, by, ["option"])


# ---------------------------------------------------------------- matching offers


def _bound(wanted: str, condition: Column) -> Column:
    """A criterion counts only when it is set to a positive number."""
    return (F.coalesce(F.col(wanted), F.lit(0)) <= 0) | condition


def _same_text(wanted: str, column: str) -> Column:
    return F.coalesce(F.lower(F.col(column)) == F.lower(F.col(wanted)), F.lit(False))


def _criteria(market: str, offer: Sequence[str], subject: Sequence[str]) -> list[Column]:
    """Conditions for the criteria that both sides know; subject columns carry the prefix ``want_``."""
    both = lambda c, w=None: c in offer and f"want_{w or c}" in subject
    terms = []
    if both("mileage"):
        terms.append(_bound("want_mileage", F.coalesce(F.col("mileage"), F.lit(0)) <= F.col("want_mileage")))
    if both("car_age"):
        terms.append(_bound("want_car_age", F.coalesce(F.col("car_age"), F.lit(0)) <= F.col("want_car_age")))
    owners = "owners" if market == "DE" else "owner_count"
    if both("owners", owners):  # the US view has no such column, so there this never acts
        terms.append(_bound(f"want_{owners}", F.coalesce(F.col("owners"), F.lit(99)) <= F.col(f"want_{owners}")))
    if both("power_ps"):
        terms.append(_bound("want_power_ps", F.coalesce(F.col("power_ps"), F.lit(0)) >= F.col("want_power_ps")))
    if market == "DE":
        for c in ("fuel", "transmission"):
            if both(c):
                terms.append(F.coalesce(F.col(f"want_{c}"), F.lit("")).isin("") | _same_text(f"want_{c}", c))
        if both("garantie_monate"):
            warranty = F.coalesce(F.col("garantie_monate"), F.lit(0))
            terms.append(_bound("want_garantie_monate", warranty >= F.col("want_garantie_monate")))
    else:
        for c in ("fuel", "trim", "engine"):
            if both(c):
                unset = F.coalesce(F.col(f"want_{c}"), F.lit("unknown")) == "unknown"
                terms.append(unset | _same_text(f"want_{c}", c))
        if both("cylinders"):
            same = F.coalesce(F.col("cylinders") == F.col("want_cylinders"), F.lit(False))
            terms.append(_bound("want_cylinders", same))
    return terms


HOT_ROWS = 5_000_000


def hot_models(view: DataFrame, rows_per_slice: int = HOT_ROWS) -> DataFrame:
    """Models with more offers than one task should take, and into how many slices they go.

    There are at most (offers / ``rows_per_slice``) of them.
    """
    sizes = view.groupBy("brand", "model").agg(F.count(F.lit(1)).alias("n"))
    return sizes.where(F.col("n") > rows_per_slice).select(
        "brand", "model", F.ceil(F.col("n") / rows_per_slice).cast("int").alias("slices")
    )


def _sliced(view: DataFrame, criteria: DataFrame, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Number the slices of hot models: an offer is in one slice, a subject asks every slice."""
    small = F.broadcast(hot)  # bounded: see hot_models
    slices = F.coalesce(F.col("slices"), F.lit(1))
    offers = view.join(small, ["brand", "model"], "left").withColumn("__slice", F.pmod(F.xxhash64("id"), slices))
    asked = criteria.join(
        small.withColumnsRenamed({"brand": "want_brand", "model": "want_model"}), ["want_brand", "want_model"], "left"
    ).withColumn("want_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), (slices - 1).cast("bigint"))))
    return offers.select(*view.columns, "__slice"), asked.drop("slices")


def _criteria_columns(subjects: DataFrame) -> list[Column]:
    return [F.col(c).alias(f"want_{c}") for c in subjects.columns if c != "subject_id"]


def _with_trim(view: DataFrame, market: str, wanted: Sequence[str]) -> DataFrame:
    """Offers with their trim, where one is asked for."""
    if market.upper() == "DE" and "want_trim" in wanted:
        return view.withColumn("__trim", F.lower(title_without_brand(F.col("title"), F.col("brand"))))
    return view


def _match_terms(offer: Sequence[str], wanted: Sequence[str], market: str) -> list[Column]:
    """All conditions between an offer and criteria with the prefix ``want_``."""
    terms = [F.col("brand") == F.col("want_brand"), F.col("model") == F.col("want_model")]
    terms += _criteria(market.upper(), offer, wanted)
    if "want_location" in wanted:
        terms.append(F.col("want_location").isNull() | F.coalesce(F.col("location") == F.col("want_location"), F.lit(False)))
    if "__trim" in offer:
        trim = F.coalesce(F.col("want_trim"), F.lit(V.ALL_TRIMS))
        terms.append((trim == V.ALL_TRIMS) | F.coalesce(F.col("__trim") == F.lower(trim), F.lit(False)))
    return terms


def match_offers(view: DataFrame, subjects: DataFrame, market: str, hot: DataFrame | None = None) -> DataFrame:
    """Offers that satisfy each subject's criteria, one row per subject and offer.

    ``subjects`` holds ``subject_id, brand, model`` and any of the criteria under their plain names,
    plus ``location`` and, for DE, ``trim``. The equi-join on brand and model is Spark's to plan: the
    subject side is broadcast only while it is below the broadcast threshold. ``hot`` (see
    ``hot_models``) cuts large models into slices for the other case. All criteria sit in the join
    condition.
    """
    criteria = subjects.select("subject_id", *_criteria_columns(subjects))
    names = [c for c in criteria.columns if c != "subject_id"]
    view = _with_trim(view, market, names)
    terms = _match_terms(view.columns, names, market)
    if hot is not None:
        view, criteria = _sliced(view, criteria, hot)
        terms.append(F.col("__slice") == F.col("want_slice"))
    matched = view.join(criteria, reduce(lambda a, b: a & b, terms))
    return matched.drop("__trim", "__slice", "want_slice", *names)


#: offers of a model that are looked at together
ROWS_PER_RUN = 10_000


def best_matches(
    view: DataFrame, subjects: DataFrame, market: str, by: str = "price", ascending: bool = True, limit: int = 20,
    rows_per_run: int = ROWS_PER_RUN,
) -> DataFrame:
    """The first ``limit`` offers of each subject with ``offer_rank``: the rows of ``best_offers`` over ``match_offers``.

    Subjects that ask the same are one question. Each model's offers are put in order once and cut into runs.
    Questions meet the first run of their model, those that are not served yet the next two, then the next four, and
    so on: every later run holds worse offers only, so a question leaves as soon as it has ``limit`` of them. A run
    is a key of its own, so a hot model's offers are never in one task, and no buyer looks at all of them unless
    his criteria leave fewer than ``limit``.
    """
    spark = view.sparkSession
    wanted = [c.replace("want_", "", 1) for c in subjects.select(*_criteria_columns(subjects)).columns]
    asked = F.sha2(F.to_json(F.struct(*wanted)), 256)
    subjects = subjects.withColumn("__asked", asked)
    questions = subjects.select("__asked", *_criteria_columns(subjects.drop("__asked"))).dropDuplicates(["__asked"])
    names = [c for c in questions.columns if c != "__asked"]
    value = F.col(_SORTS[by]).cast("double")
    ordered = _with_trim(view, market, names).where(F.col("brand").isNotNull() & F.col("model").isNotNull())
    ordered = ordered.withColumns({"__missing": value.isNull(), "__value": value if ascending else -value})
    placed = with_ordinal(ordered, ["brand", "model"], ["__missing", "__value", "id"], "__place")
    runs = write_table(
        placed.withColumn("__run", F.floor((F.col("__place") - 1) / rows_per_run)), scratch_path(spark, "runs")
    )
    last = runs.groupBy("brand", "model").agg(F.max("__run").alias("__last"))
    last = last.select(F.col("brand").alias("want_brand"), F.col("model").alias("want_model"), "__last")
    open_ = questions.join(last, ["want_brand", "want_model"]).withColumn("__have", F.lit(0).cast("bigint"))
    open_ = write_table(open_, scratch_path(spark, "questions"))
    terms = _match_terms(runs.columns, names, market) + [F.col("__run") == F.col("want_run")]
    shown = [*view.columns, "__asked", "offer_rank"]
    start, width, found = 0, 1, []
    while True:
        span = F.sequence(F.lit(start).cast("bigint"), F.least(F.lit(start + width - 1).cast("bigint"), F.col("__last")))
        meeting = open_.withColumn("want_run", F.explode(span))
        hits = runs.join(meeting, reduce(lambda a, b: a & b, terms))
        top = top_rows(hits, ["__asked"], ["__place"], limit, "__rank").withColumn("offer_rank", F.col("__have") + F.col("__rank"))
        found.append(write_table(top.where(F.col("offer_rank") <= limit).select(*shown), scratch_path(spark, "found")))
        start, width = start + width, 2 * width
        more = found[-1].groupBy("__asked").agg(F.max("offer_rank").alias("__now"))
        rest = open_.where(F.col("__last") >= start).join(more, "__asked", "left")
        rest = rest.withColumn("__have", F.coalesce("__now", "__have")).where(F.col("__have") < limit).drop("__now")
        open_ = write_table(rest, scratch_path(spark, "questions"))
        if open_.isEmpty():
            break
    answers = reduce(DataFrame.unionByName, found).withColumn("offer_rank", F.col("offer_rank").cast("int"))
    return answers.join(subjects.select("subject_id", "__asked"), "__asked").drop("__asked")


_SORTS = {"price": "price", "mileage": "mileage"}


def sort_key(by: str = "price", ascending: bool = True) -> Column:
    """Price or mileage with missing values last either way."""
    column = F.col(_SORTS[by])
    return column.asc_nulls_last() if ascending else column.desc_nulls_last()


def best_offers(
    matches: DataFrame, by: str = "price", ascending: bool = True, limit: int | None = 20
) -> DataFrame:
    """Each subject's first offers with rank; all of them, sorted, without a limit.

    With a limit every task forwards at most ``limit`` offers per subject. Without one the rows are
    range-partitioned by subject and sort key, so that no task has to hold a whole subject.
    """
    order = [sort_key(by, ascending), F.col("id")]
    if limit is None:
        return matches.orderBy("subject_id", *order)
    return top_rows(matches, ["subject_id"], order, limit, "offer_rank")


def offer_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("subject_id").agg(F.count(F.lit(1)).alias("offers"))


def display_offers(offers: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Shown columns; the link is empty unless it begins with http."""
    link = F.when(F.col("url").startswith("http"), F.col("url")).otherwise("")
    return offers.select(*extra, "title", "price", "mileage", "location", link.alias("link"))


def leading_models(view: DataFrame, position: str = "id", limit: int = V.MODEL_LIMIT) -> DataFrame:
    """``(brand, models)``: the first ``limit + 1`` models of each brand by first appearance.

    One more than needed, since a subject's own model drops out. The array is never longer than that.
    """
    first = view.where(F.col("model").isNotNull()).groupBy("brand", "model").agg(F.min(position).alias("seen"))
    head = top_rows(first, ["brand"], ["seen", "model"], limit + 1, "__rank")
    return head.groupBy("brand").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seen", "model"))), lambda x: x["model"]).alias("models")
    )


def other_models(models: Column, own: Column, limit: int = V.MODEL_LIMIT) -> Column:
    """The first ``limit`` models that are not the subject's own."""
    return F.slice(F.filter(models, lambda m: m != F.coalesce(own, F.lit(""))), 1, limit)


def alternative_models(view: DataFrame, subjects: DataFrame, position: str = "id", limit: int = V.MODEL_LIMIT) -> DataFrame:
    """Other models of each subject's brand with their rank; no shuffle by subject is needed."""
    joined = subjects.select("subject_id", "brand", "model").join(leading_models(view, position, limit), "brand")
    return joined.select(
        "subject_id", "brand", "model", F.posexplode(other_models(F.col("models"), F.col("model"), limit)).alias("p", "alt_model")
    ).select("subject_id", "brand", "model", "alt_model", (F.col("p") + 1).alias("alt_rank"))
