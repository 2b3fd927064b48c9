"""Column profiling.

The table is reduced once to distinct (column, value, n) rows. Everything else
reads those rows, so each parser runs once per distinct value, and every
statistic is a partial aggregate: a column that is one value a third of the
time costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions import numbers as N
from ..functions import text as X
from ..session import cut_lineage
from ..functions.similarity import MAX_LENGTH_GAP, SAME_VALUE_RATIO, edit_similarity, match_ratio

# The limits of the kind decision.
LIST_SEPARATORS = (";", "|", "\n", ",", "/")
LIST_MIN_SHARE = 0.15
LIST_MAX_TOKEN_LEN = 40
LIST_MAX_DISTINCT = 60
ENUM_MAX_DISTINCT = 40
ENUM_MAX_LEN = 60
FREETEXT_MIN_LEN = 80
BOOLISH_MAX_DISTINCT = 4
VALUE_MAP_MAX_DISTINCT = 25
COLUMN_MIN_FILL = 0.9

# Words in the header of an id or a group column.
ID_HINTS = (
    r"(?i)\b(id|nr|nummer|projekt|project|anwendung|application|system|name|"
    r"bezeichnung|titel|title|app|service|kürzel|kuerzel|akronym)\b")
GROUP_HINTS = (
    r"(?i)\b(team|abteilung|bereich|organisation|org|owner|verantwortlich|"
    r"fachbereich|gruppe|unit|domain)\b")

# Unit -> suffix of the field name, and the spellings of that
# unit which already carry it.
UNIT_SUFFIXES = {
    "gb": "gb", "gib": "gb", "tb": "tb", "tib": "tb", "mb": "mb",
    "cores": "cores", "core": "cores", "kerne": "cores", "kern": "cores",
    "vcpu": "cores", "cpu": "cores", "cpus": "cores",
    "h": "hours", "std": "hours", "stunden": "hours",
    "min": "minutes", "minuten": "minutes", "%": "pct", "eur": "eur", "€": "eur",
}
SUFFIX_SPELLINGS = {
    "gb": ("gb", "gib", "gbyte"), "tb": ("tb", "tib"), "mb": ("mb", "mib"),
    "cores": ("core", "cores", "kern", "kerne", "cpu", "cpus", "vcpu"),
    "hours": ("h", "hours", "std", "stunden"),
    "minutes": ("min", "minutes", "minuten"),
    "pct": ("pct", "prozent", "percent"), "eur": ("eur", "euro"),
}


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct cleaned cells per column with their counts (index, column, value, n).

    An empty cell counts under a NULL value, so fill rates come along.
    """
    columns = list(columns or df.columns)
    ready = df.select(*[X.clean_cell(F.col(f"`{c}`").cast("string")).alias(c) for c in columns])
    long = ready.unpivot([], columns, "column", "value")
    index = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)]),
                         F.col("column"))
    counted = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(index.alias("index"), "column", "value", "n")


def stored_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``value_counts`` written once: a profile reads it several times."""
    return cut_lineage(value_counts(df, columns))


class Stages:
    """The steps of one profile, each computed once and then read back.

    Votes and separators have a few rows per column; settling them first keeps
    the later plans small and splits only the columns that are lists.
    """

    def __init__(self, counts: DataFrame):
        self.counts = counts

    @cached_property
    def votes(self) -> DataFrame:
        return cut_lineage(cell_votes(self.counts))

    @cached_property
    def separators(self) -> DataFrame:
        return cut_lineage(list_separator(self.counts, self.votes))

    @cached_property
    def tokens(self) -> DataFrame:
        return cut_lineage(token_counts(self.counts, self.separators))

    @cached_property
    def profile(self) -> DataFrame:
        return cut_lineage(profile_columns(self.counts, self))


def _filled(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("value").isNotNull())


def _tokens_of(value: Column, sep: Column | str) -> Column:
    if isinstance(sep, Column):
        pattern = F.concat(F.lit(r"\Q"), sep, F.lit(r"\E"))
    else:
        pattern = F.lit(r"\Q" + sep + r"\E")
    return F.filter(F.transform(F.split(value, pattern), lambda t: X.strip(t)), lambda t: t != "")


def fill_statistics(counts: DataFrame) -> DataFrame:
    """Total, filled, fill rate and distinct values per column."""
    filled = F.col("value").isNotNull()
    return (counts.groupBy("index", "column")
            .agg(F.sum("n").alias("total"),
                 F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("filled"),
                 F.count_if(filled).alias("distinct"))
            .withColumn("fill_rate", F.when(F.col("total") > 0, F.col("filled") / F.col("total"))
                        .otherwise(F.lit(0.0))))


def approx_fill_statistics(df: DataFrame, columns: Sequence[str] | None = None,
                           rsd: float = 0.02) -> DataFrame:
    """The same in one pass with estimated distinct counts, for very wide data."""
    columns = list(columns or df.columns)
    clean = df.select(*[X.clean_cell(F.col(f"`{c}`").cast("string")).alias(c) for c in columns])
    stats = clean.agg(*[F.struct(F.count(F.lit(1)).alias("total"), F.count(f"`{c}`").alias("filled"),
                                 F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias("distinct")).alias(c)
                        for c in columns])
    return stats.unpivot([], columns, "column", "s").select("column", "s.*")


def top_values(tokens: DataFrame, k: int = ENUM_MAX_DISTINCT + 1) -> DataFrame:
    """The k most frequent values per column; equal counts go by value.

    The rank filter lets every task keep only its own k candidates per column
    before rows meet.
    """
    order = W.partitionBy("column").orderBy(F.desc("n"), "value")
    return (tokens.select("column", "value", "n").withColumn("position", F.row_number().over(order))
            .where(F.col("position") <= k))


def number_locale(counts: DataFrame) -> DataFrame:
    """``de``, ``en`` or ``ambiguous`` per column, from what its cells prove."""
    seen = N.locale_evidence(F.col("value"))
    votes = {k: F.coalesce(F.bool_or(v), F.lit(False)).alias(f"any_{k}") for k, v in seen.items()}
    return (_filled(counts).groupBy("index", "column").agg(*votes.values())
            .select("index", "column",
                    N.decide_locale(F.col("any_de"), F.col("any_en"), F.col("any_open"))
                    .alias("number_locale")))


def cell_votes(counts: DataFrame) -> DataFrame:
    """Per column: do all cells parse, how long are they, which separators occur."""
    value, n = F.col("value"), F.col("n")
    # Each reading is a column of its own, so that none is computed twice.
    read = (_filled(counts)
            .select("*", N.number_body(value).alias("_body"), F.lower(N.number_unit(value)).alias("_unit"),
                    N.parse_date(value).isNotNull().alias("_date"),
                    X.parse_boolish(value).isNotNull().alias("_bool"),
                    *[_tokens_of(value, sep).alias(f"_tok{i}") for i, sep in enumerate(LIST_SEPARATORS)])
            .select("*", N.plain_number("_body", "de").try_cast("double").alias("_de"),
                    N.plain_number("_body", "en").try_cast("double").alias("_en"),
                    *[v.alias(f"_any_{k}") for k, v in N.locale_evidence("_body").items()]))
    number, length = F.col("_de"), F.length(value)
    aggregates = [
        F.sum(n).alias("cells"), F.count(F.lit(1)).alias("distinct_cells"),
        F.bool_and("_date").alias("all_dates"),
        F.bool_and(number.isNotNull()).alias("all_numbers"),
        F.bool_and("_bool").alias("all_boolish"),
        F.coalesce(F.bool_and(N.is_whole(number)), F.lit(False)).alias("whole_de"),
        F.coalesce(F.bool_and(N.is_whole(F.col("_en"))), F.lit(False)).alias("whole_en"),
        F.sum(length * n).alias("chars"), F.max(length).alias("longest"),
        # Two extremes tell one unit from several without collecting them.
        F.min(F.when(number.isNotNull(), F.col("_unit"))).alias("unit_low"),
        F.max(F.when(number.isNotNull(), F.col("_unit"))).alias("unit_high"),
        *[F.coalesce(F.bool_or(f"_any_{k}"), F.lit(False)).alias(f"any_{k}") for k in ("de", "en", "open")],
    ]
    for i, sep in enumerate(LIST_SEPARATORS):
        tokens = F.col(f"_tok{i}")
        aggregates += [
            F.sum(F.when(value.contains(sep), n).otherwise(0)).alias(f"sep{i}_cells"),
            F.sum(F.size(tokens) * n).alias(f"sep{i}_tokens"),
            F.max(F.array_max(F.transform(tokens, lambda t: F.length(t)))).alias(f"sep{i}_longest"),
        ]
    return read.groupBy("index", "column").agg(*aggregates)


def list_separator(counts: DataFrame, votes: DataFrame | None = None) -> DataFrame:
    """The separator of multi-value columns.

    Share of cells, number and length of tokens come from one aggregate. Only
    separators that pass those are split for real, to count distinct tokens.
    """
    votes = cell_votes(counts) if votes is None else votes
    possible = F.filter(F.array(*[
        F.when((F.col(f"sep{i}_cells") >= LIST_MIN_SHARE * F.col("cells"))
               & (F.col(f"sep{i}_longest") <= LIST_MAX_TOKEN_LEN)
               & (F.col(f"sep{i}_tokens") > F.col("cells")),
               F.struct(F.lit(i).alias("place"), F.lit(sep).alias("sep")))
        for i, sep in enumerate(LIST_SEPARATORS)]), lambda s: s.isNotNull())
    candidates = (votes.where(~F.col("all_dates") & ~F.col("all_numbers"))
                  .select("index", "column", F.explode(possible).alias("_c"))
                  .select("index", "column", "_c.place", "_c.sep"))
    # One row per column and separator: as many rows as the table is wide.
    split = (_filled(counts).join(F.broadcast(candidates), ["index", "column"])
             .select("index", "column", "place", "sep", F.explode(_tokens_of(F.col("value"), F.col("sep"))).alias("token"))
             .groupBy("index", "column", "place", "sep").agg(F.countDistinct("token").alias("tokens"))
             .where(F.col("tokens") <= LIST_MAX_DISTINCT))
    return (split.groupBy("index", "column")
            .agg(F.min_by("sep", "place").alias("list_separator")))


def token_counts(counts: DataFrame, separators: DataFrame) -> DataFrame:
    """Cells of list columns split into tokens; other columns as they are."""
    split = _filled(counts).join(F.broadcast(separators), ["index", "column"], "left")
    tokens = (F.when(F.col("list_separator").isNotNull(), _tokens_of(F.col("value"), F.col("list_separator")))
              .otherwise(F.array("value")))
    return (split.select("index", "column", F.explode(tokens).alias("value"), "n")
            .groupBy("index", "column", "value").agg(F.sum("n").alias("n")))


explode_tokens = token_counts


def separator_hints(votes: DataFrame, separators: DataFrame) -> DataFrame:
    """Other separators that also occur in a list column."""
    found = F.filter(F.array(*[
        F.when((F.col(f"sep{i}_cells") > 0) & (F.col("list_separator") != sep), F.lit(sep))
        for i, sep in enumerate(LIST_SEPARATORS)]), lambda s: s.isNotNull())
    return (votes.join(separators, ["index", "column"])
            .select("index", "column", "list_separator", found.alias("also")))


def header_unit(header) -> Column:
    return F.nullif(F.lower(F.regexp_extract(X.col(header), N.HEADER_UNIT, 1)), F.lit(""))


def detect_unit(votes: DataFrame) -> DataFrame:
    """Unit from the header, else the one unit all values carry."""
    single = F.when(F.col("all_numbers") & (F.col("unit_low") == F.col("unit_high")), F.col("unit_low"))
    mixed = F.col("all_numbers") & (F.col("unit_low") != F.col("unit_high"))
    return votes.select("index", "column", F.coalesce(header_unit("column"), single).alias("unit"),
                        F.coalesce(mixed, F.lit(False)).alias("mixed_units"))


def suffix_unit(field: Column, unit: Column) -> Column:
    """Append the unit to a field name unless a part of it says it already."""
    suffixes = F.create_map(*[F.lit(x) for pair in UNIT_SUFFIXES.items() for x in pair])
    spellings = F.create_map(*[x for k, v in SUFFIX_SPELLINGS.items()
                               for x in (F.lit(k), F.array(*map(F.lit, v)))])
    suffix = F.try_element_at(suffixes, F.lower(unit))
    said = F.arrays_overlap(F.split(field, "_"), F.try_element_at(spellings, suffix))
    return F.when(suffix.isNotNull() & ~said, F.concat_ws("_", field, suffix)).otherwise(field)


def profile_columns(counts: DataFrame, stages: Stages | None = None, decimals: Mapping[str, str] | None = None) -> DataFrame:
    """One row per column: fill, distinct, unit, locale, separator and kind.

    ``decimals`` settles the number locale (``de`` or ``en``) of columns that the vote gets wrong.
    """
    stages = stages or Stages(counts)
    votes, separators, tokens = stages.votes, stages.separators, stages.tokens
    token_stats = tokens.groupBy("index", "column").agg(
        F.count(F.lit(1)).alias("token_distinct"), F.sum("n").alias("token_total"),
        F.sum(F.length("value") * F.col("n")).alias("token_chars"),
        F.max(F.length("value")).alias("token_longest"))
    fill = fill_statistics(counts).drop("distinct")
    units = detect_unit(votes)
    joined = (fill.join(votes, ["index", "column"], "left").join(separators, ["index", "column"], "left")
              .join(token_stats, ["index", "column"], "left").join(units, ["index", "column"], "left"))
    if decimals:
        said = F.create_map(*[F.lit(x) for pair in decimals.items() for x in pair])
        chosen = F.try_element_at(said, F.col("column"))
        joined = joined.withColumns({f"any_{k}": F.when(chosen.isNotNull(), chosen == k).otherwise(F.col(f"any_{k}"))
                                     for k in ("de", "en", "open")})
    locale = N.decide_locale(F.col("any_de"), F.col("any_en"), F.col("any_open"))
    kind = classify()
    profiled = (joined.withColumn("_locale", locale).withColumn("kind", kind)
                .withColumn("_slug", X.slugify("column")))
    numeric = F.col("kind").isin("integer", "number")
    return profiled.select(
        "index", "column",
        F.when(numeric, suffix_unit(F.col("_slug"), F.col("unit"))).otherwise(F.col("_slug")).alias("field"),
        "total", "filled", "fill_rate",
        F.coalesce("token_distinct", F.lit(0)).alias("distinct"), "kind",
        F.when(numeric | F.col("unit").isNotNull(), F.col("unit")).alias("unit"),
        F.coalesce("mixed_units", F.lit(False)).alias("mixed_units"),
        F.when(numeric | (F.col("kind").isin("enum", "string", "freetext")), F.col("_locale"))
        .otherwise(F.lit("en")).alias("number_locale"),
        "list_separator")


def classify() -> Column:
    """The kind cascade over the profile aggregates of one column."""
    distinct, longest = F.col("token_distinct"), F.col("token_longest")
    locale = N.decide_locale(F.col("any_de"), F.col("any_en"), F.col("any_open"))
    whole = F.when(locale == "en", F.col("whole_en")).otherwise(F.col("whole_de"))
    average = F.col("token_chars") / F.col("token_total")
    free = (((average >= FREETEXT_MIN_LEN) | (distinct > ENUM_MAX_DISTINCT))
            & (longest > ENUM_MAX_LEN) & (distinct > ENUM_MAX_DISTINCT))
    return (F.when(F.col("filled") == 0, F.lit("empty"))
             .when(F.col("list_separator").isNotNull(), F.lit("list"))
             .when(F.col("all_dates"), F.lit("date"))
             .when(F.col("all_boolish") & (distinct <= BOOLISH_MAX_DISTINCT), F.lit("boolish"))
             .when(F.col("all_numbers") & whole, F.lit("integer"))
             .when(F.col("all_numbers"), F.lit("number"))
             .when(free, F.lit("freetext"))
             .when((distinct <= ENUM_MAX_DISTINCT) & (longest <= ENUM_MAX_LEN), F.lit("enum"))
             .otherwise(F.lit("string")))


def code_list_tokens(tokens: DataFrame) -> DataFrame:
    """Tokens of columns short enough to be code lists (at most 40 values)."""
    small = (tokens.groupBy("index", "column")
             .agg(F.count(F.lit(1)).alias("_d"), F.max(F.length("value")).alias("_l"))
             .where((F.col("_d") <= ENUM_MAX_DISTINCT) & (F.col("_l") <= ENUM_MAX_LEN)))
    return tokens.join(F.broadcast(small.select("index", "column")), ["index", "column"], "left_semi")


def spelling_clusters(tokens: DataFrame) -> DataFrame:
    """Spellings of one value, for columns short enough to be code lists."""
    return (code_list_tokens(tokens).withColumn("cluster", X.spelling_key("value"))
            .where(F.col("cluster") != "")
            .groupBy("index", "column", "cluster")
            .agg(F.sort_array(F.collect_set("value")).alias("spellings"), F.sum("n").alias("n")))


def similar_values(clusters: DataFrame, measure: str = "ratio",
                   threshold: float = SAME_VALUE_RATIO) -> DataFrame:
    """Clusters of one column that are probably the same value.

    Clusters exist only for columns of at most 40 values, which bounds the
    pairs of a column; each value meets only values of nearly its own length.
    """
    keys = F.col("cluster")
    left = clusters.select("column", keys.alias("a"), F.col("spellings")[0].alias("value_a"),
                           F.explode(F.sequence(F.length(keys) - MAX_LENGTH_GAP,
                                                F.length(keys) + MAX_LENGTH_GAP)).alias("_len"))
    right = clusters.select("column", keys.alias("b"), F.col("spellings")[0].alias("value_b"),
                            F.length(keys).alias("_len"))
    pairs = left.join(right, ["column", "_len"]).where(F.col("a") < F.col("b")).drop("_len")
    score = match_ratio(F.col("a"), F.col("b")) if measure == "ratio" else edit_similarity("a", "b")
    return pairs.withColumn("score", score).where(F.col("score") >= threshold)


def canonical_values(tokens: DataFrame) -> DataFrame:
    """The most frequent spelling of each value; on a tie the shorter one, then the first in code point order."""
    return (tokens.withColumn("cluster", X.spelling_key("value"))
            .groupBy("column", "cluster")
            .agg(F.min_by("value", F.struct(-F.col("n"), F.length("value"), F.col("value"))).alias("canonical"),
                 F.count(F.lit(1)).alias("spellings"), F.sum("n").alias("n")))


def is_code_list(limit: int = VALUE_MAP_MAX_DISTINCT) -> Column:
    mostly_unique = ((F.col("kind") != "list") & (F.col("filled") > 5)
                     & (F.col("distinct") > 0.5 * F.col("filled")))
    return (F.col("kind").isin("enum", "list", "boolish") & ~mostly_unique
            & (F.col("distinct") <= limit))


def propose_value_map(profile: DataFrame, tokens: DataFrame) -> DataFrame:
    """Starter value map of the code-list columns: value -> code, or not set."""
    listed = profile.where(is_code_list()).select("index", "column")
    values = tokens.join(F.broadcast(listed), ["index", "column"], "left_semi")
    values = values.withColumn("cluster", X.spelling_key("value"))
    best = canonical_values(values).select("column", "cluster", "canonical")
    return (values.join(F.broadcast(best), ["column", "cluster"])
            .select("column", "value", "n",
                    F.when(~F.col("cluster").isin(*X.NOT_SET_MARKERS), X.slugify("canonical")).alias("code")))


def value_map_skipped(profile: DataFrame) -> DataFrame:
    """Columns that look like code lists but hold too many values."""
    return (profile.where(F.col("kind").isin("enum", "list", "boolish") & ~is_code_list())
            .select("column", "distinct", "filled"))


def pick_column(profile: DataFrame, role: str, explicit: str | None = None) -> DataFrame:
    """The id or group column, as one row (none when nothing qualifies)."""
    if explicit and explicit.strip().lower() == "none":
        return profile.select("column").limit(0)
    if explicit:
        found = profile.where(F.col("column") == explicit).select("column")
        return found
    hinted = F.col("column").rlike(ID_HINTS if role == "id" else GROUP_HINTS)
    unique = F.col("distinct") == F.col("filled")
    usable = profile.where((F.col("kind") != "empty") & (F.col("fill_rate") >= COLUMN_MIN_FILL))
    if role == "id":
        usable = usable.where(unique)
    else:
        usable = usable.where(hinted & ~(unique & (F.col("filled") > 3)))
    score = F.when(hinted, 2).otherwise(0) + F.when(unique, 1).otherwise(0)
    return (usable.withColumn("_score", score).where(F.col("_score") > 0)
            .agg(F.max_by("column", F.struct(F.col("_score"), -F.col("index"))).alias("column"))
            .where(F.col("column").isNotNull()))


def saturation(numbered: DataFrame, columns: Sequence[str], row: str = "row_no") -> DataFrame:
    """Distinct values after a quarter, half and all of the rows.

    A plateau is a vocabulary, steady growth an identifier. A value counts from
    the row where it first appears, so one minimum per value is enough.
    """
    total = numbered.agg(F.max(row)).scalar()
    share = F.ceil(F.col(row) * 4 / total)
    cells = numbered.select(share.cast("int").alias("_q"),
                            *[X.clean_cell(F.col(f"`{c}`").cast("string")).alias(c) for c in columns])
    first = (cells.unpivot(["_q"], list(columns), "column", "value").where(F.col("value").isNotNull())
             .groupBy("column", "value").agg(F.min("_q").alias("_q")))
    return first.groupBy("column").agg(
        F.count_if(F.col("_q") <= 1).alias("distinct_25"),
        F.count_if(F.col("_q") <= 2).alias("distinct_50"),
        F.count(F.lit(1)).alias("distinct_100"))


def profile_report(counts: DataFrame, stages: Stages | None = None) -> DataFrame:
    """The profile with its hints as a list of texts."""
    stages = stages or Stages(counts)
    profile, votes, separators, tokens = stages.profile, stages.votes, stages.separators, stages.tokens
    clusters = spelling_clusters(tokens).groupBy("column").agg(
        F.count_if(F.size("spellings") > 1).alias("_merged"))
    others = separator_hints(votes, separators).select("column", "also")
    joined = (profile.join(F.broadcast(clusters), "column", "left")
              .join(F.broadcast(others), "column", "left"))
    hints = F.array(
        F.when(F.col("kind") == "empty", F.lit("column is completely empty")),
        F.when(F.size("also") > 0, F.lit("other separators also appear")),
        F.when(F.col("kind") == "boolish", F.lit("looks like yes/no")),
        F.when(F.col("mixed_units"), F.lit("mixed units in cells")),
        F.when(F.col("kind").isin("integer", "number") & (F.col("number_locale") == "ambiguous"),
               F.lit("ambiguous decimal separator, read as German")),
        F.when(F.col("kind").isin("enum", "list") & (F.col("_merged") > 0),
               F.concat(F.col("_merged").cast("string"), F.lit(" value(s) appear in several spellings"))),
    )
    return joined.withColumn("hints", F.array_compact(hints)).drop("_merged", "also")


# ---------------------------------------------------------------- schema

_LEAF = {"integer": T.LongType(), "number": T.DoubleType()}


def derive_schema(profile: DataFrame, tokens: DataFrame, mapping: dict[str, str | None],
                  value_map: dict[str, dict] | None = None) -> T.StructType:
    """A nested schema from the profile and a mapping of headers to paths.

    Code-list columns carry their mapped values plus ``unknown`` in the field
    metadata. Reads the profile, which has one row per column.
    """
    from .convert import mapped_codes, target

    value_map = value_map or {}
    listed = profile.where(is_code_list(ENUM_MAX_DISTINCT)).select("index", "column")
    words = tokens.join(F.broadcast(listed), ["index", "column"], "left_semi")
    codes = {}
    if mapping:
        mapped = reduce(DataFrame.unionByName, [
            words.where(F.col("column") == h).select(
                "column", F.explode(mapped_codes(F.col("value"), value_map.get(p, {}))).alias("code"))
            for h, p in mapping.items() if p])
        codes = {r["column"]: sorted({*r["codes"], X.UNKNOWN})
                 for r in mapped.groupBy("column").agg(F.collect_set("code").alias("codes")).collect()}
    root: dict = {}
    for row in profile.orderBy("index").collect():
        path = mapping.get(row["column"])
        if not path:
            continue
        leaf = _LEAF.get(row["kind"], T.StringType())
        meta = {"source_column": row["column"], "kind": row["kind"]}
        if row["column"] in codes:
            meta["enum"] = codes[row["column"]]
        if row["kind"] == "list" and "[" not in path:
            leaf = T.ArrayType(T.StringType())
        node = root
        steps = target(path)
        for i, step in enumerate(steps):
            name, is_list = step.name, step.place is not None
            if i == len(steps) - 1:
                node[name] = (T.ArrayType(leaf) if is_list else leaf, meta)
            else:
                child = node.setdefault(name, ({}, {"list": is_list}))
                node = child[0]
    return _struct(root)


def _struct(node: dict) -> T.StructType:
    fields = []
    for name, (child, meta) in node.items():
        if isinstance(child, dict):
            inner = _struct(child)
            fields.append(T.StructField(name, T.ArrayType(inner) if meta["list"] else inner))
        else:
            fields.append(T.StructField(name, child, True, meta))
    return T.StructType(fields)
