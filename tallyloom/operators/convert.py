"""Conversion of a flat, all-text table into nested records.

A mapping names the target path of each header:

    a.b       nested scalar
    a.b[]     list of scalars
    a.b[].c   list of records, columns under one prefix zipped by position
    a.b[0].c  one fixed place of a list
    None      kept verbatim in ``_unmapped``

Everything is one generated ``select``; no column is exploded or shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import numbers as N
from ..functions import text as X
from .keyed import attach_by_key, row_numbers, small_side

ID_WIDTH = 60
NO_ID = "projekt"

EVERY = -1
_NAME = r"[A-Za-z_][A-Za-z0-9_-]*"
_STEP = rf"({_NAME})(\[(\d*)\])?"
_PATH = re.compile(rf"{_STEP}(?:\.{_STEP})*")


@dataclass(frozen=True)
class Step:
    """One name of a target path; ``place`` is None for a single value, EVERY for all
    elements of a list, else the number of one element."""

    name: str
    place: int | None


@lru_cache
def target(path: str) -> tuple[Step, ...]:
    compact = re.sub(r"\s*\.\s*", ".", path.strip())
    if not _PATH.fullmatch(compact):
        raise ValueError(f"not a target path: {path!r}")
    return tuple(Step(name, None if not mark else int(number or EVERY)) for name, mark, number in re.findall(_STEP, compact))


def every_prefix(path: str) -> str | None:
    """The path of the list whose elements this path spreads over, if it does."""
    shown = []
    for step in target(path):
        shown.append(step.name + ("" if step.place is None else "[]" if step.place == EVERY else f"[{step.place}]"))
        if step.place == EVERY:
            return ".".join(shown)
    return None


# -------------------------------------------------------------- cell level

def coerce(c, kind: str, locale: str = "en") -> Column:
    """The typed reading of a cleaned cell as text; what cannot be read stays."""
    c = X.col(c)
    if kind == "date":
        return F.coalesce(N.iso_date(N.parse_date(c)), c)
    if kind in ("integer", "number"):
        return F.coalesce(N.number_text(N.plain_number(N.number_body(c), locale)), c)
    if kind == "boolish":
        return F.coalesce(X.parse_boolish(c), c)
    return c


def coercion_failed(c, kind: str, locale: str = "en") -> Column:
    c = X.col(c)
    if kind == "date":
        return c.isNotNull() & N.parse_date(c).isNull()
    if kind in ("integer", "number"):
        return c.isNotNull() & N.parse_number(c, locale).isNull()
    return F.lit(False)


def clean_table(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every cell cleaned once, before anything reads it."""
    return df.select(*[F.col(f"`{c}`") if c in keep
                       else X.clean_cell(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def _targets(value) -> list[str]:
    if value is None:
        return []
    return [str(v) for v in value] if isinstance(value, (list, tuple)) else [str(value)]


def mapped_codes(c, value_map: Mapping[str, object]) -> Column:
    """The codes one value stands for: exact spelling, then the spelling key,
    else the value itself. NULL and "not set" give an empty list."""
    c = X.col(c)
    passed = F.array(c)
    if value_map:
        exact = F.create_map(*[x for k, v in value_map.items()
                               for x in (F.lit(k), F.array(*map(F.lit, _targets(v))).cast("array<string>"))])
        keys = _spelling_keys(value_map)
        loose = F.create_map(*[x for k, v in keys.items()
                               for x in (F.lit(k), F.array(*map(F.lit, _targets(v))).cast("array<string>"))])
        passed = F.coalesce(F.try_element_at(exact, c), F.try_element_at(loose, X.spelling_key(c)), passed)
    return F.when(c.isNotNull(), passed).otherwise(F.array().cast("array<string>"))


def _spelling_keys(value_map: Mapping[str, object]) -> dict[str, object]:
    # The map is a small config: its keys are normalised here, once.
    import unicodedata

    out = {}
    for key, target in value_map.items():
        for char, word in X.EXPANSIONS:
            key = key.replace(char, word)
        bare = "".join(ch for ch in unicodedata.normalize("NFKD", key) if not unicodedata.combining(ch))
        out[re.sub("[^a-z0-9]+", "", bare.lower())] = target
    return out


def pieces(c, spec: Mapping, value_map: Mapping[str, object]) -> Column:
    """All target values of one cleaned cell: split, coerced, mapped."""
    c = X.col(c)
    sep = spec.get("list_separator")
    if sep:
        parts = F.filter(F.transform(F.split(c, r"\Q" + sep + r"\E"), lambda t: X.strip(t)), lambda t: t != "")
    else:
        parts = F.array_compact(F.array(c))
    kind, locale = spec.get("kind", "string"), spec.get("number_locale", "en")
    if kind in ("date", "integer", "number", "boolish"):
        parts = F.transform(parts, lambda p: coerce(p, kind, locale))
    if value_map:
        parts = F.flatten(F.transform(parts, lambda p: mapped_codes(p, value_map)))
    return F.coalesce(parts, F.array().cast("array<string>"))


# ------------------------------------------------------------ record level

def zip_lists(columns: Mapping[str, Column]) -> Column:
    """Columns of one list zipped by position, short ones padded with NULL."""
    names = list(columns)
    zipped = F.arrays_zip(*[columns[n].alias(n) for n in names])
    return F.transform(zipped, lambda e: F.struct(*[e.getField(n).alias(n) for n in names]))


def _is_mapped(path) -> bool:
    return path not in (None, "null")


def convert(df: DataFrame, mapping: Mapping[str, str | None], profile: Mapping[str, Mapping] | None = None,
            value_map: Mapping[str, Mapping] | None = None, keep: Sequence[str] = (),
            keep_empty: bool = False) -> DataFrame:
    """Records from a flat table: ``record`` (nested), ``_unmapped`` (map) and
    the columns named in ``keep``. Rows that hold nothing are left out.

    ``profile`` gives kind, number_locale and list_separator per header.
    """
    profile, value_map = profile or {}, value_map or {}
    df = clean_table(df, keep)
    headers = [c for c in df.columns if c not in keep]
    mapped = {h: str(p).strip() for h, p in mapping.items() if _is_mapped(p) and h in headers}
    found = {h: F.col(f"`_p_{i}`") for i, h in enumerate(mapped)}
    prepared = df.select("*", *[pieces(F.col(f"`{h}`"), profile.get(h, {}), value_map.get(p, {})).alias(f"_p_{i}")
                                for i, (h, p) in enumerate(mapped.items())])
    leaves = {target(p): Leaf.of(found[h], profile.get(h, {}), value_map.get(p, {})) for h, p in mapped.items()}
    loose = [h for h in headers if h not in mapped]
    unmapped = _capture(loose, profile)
    filled = F.lit(False)
    for values in found.values():
        filled = filled | (F.size(values) > 0)
    record = _record(list(leaves.items())) if leaves else F.struct(F.lit(None).cast("string").alias("_empty"))
    out = prepared.select(*keep, record.alias("record"), unmapped.alias("_unmapped"), filled.alias("_filled"))
    return out.where(F.col("_filled") | (F.size("_unmapped") > 0) | F.lit(keep_empty)).drop("_filled")


@dataclass(frozen=True)
class Leaf:
    """The values of one mapped column, as text, and what they become.

    Text stays text. Numbers, and columns that may give several values where the path
    has room for one, are variants: numbers as numbers, what could not be read as the
    text it was, several values as a list."""

    values: Column
    number: bool
    several: bool

    @staticmethod
    def of(values: Column, spec: Mapping, value_map: Mapping[str, object]) -> Leaf:
        lists = any(isinstance(v, (list, tuple)) for v in value_map.values())
        return Leaf(values, spec.get("kind") in ("integer", "number"), bool(spec.get("list_separator")) or lists)

    @property
    def shape(self) -> str:
        return "variant" if self.number or self.several else "string"

    def typed(self, value: Column) -> Column:
        if not self.number:
            return value
        whole, decimal = value.rlike(r"^-?\d+$"), value.rlike(r"^-?\d+\.\d+$")
        return F.coalesce(F.when(whole, value.try_cast("bigint")).cast("variant"),
                          F.when(whole | decimal, value.try_cast("double")).cast("variant"), value.cast("variant"))

    def one(self) -> Column:
        first = F.get(self.values, F.lit(0))
        if self.shape == "string":
            return first
        return (F.when(F.size(self.values) == 1, self.typed(first).cast("variant"))
                .when(F.size(self.values) > 1, F.transform(self.values, self.typed).cast("variant")))

    def all(self) -> Column:
        return F.transform(self.values, self.typed) if self.number else self.values


_Leaves = list[tuple[tuple[Step, ...], Leaf]]


def _record(leaves: _Leaves) -> Column:
    """A struct of the fields that the paths begin with, in order of their names."""
    fields: dict[str, _Leaves] = {}
    for steps, leaf in leaves:
        fields.setdefault(steps[0].name, []).append((steps, leaf))
    return F.struct(*[_field(name, members).alias(name) for name, members in sorted(fields.items())])


def _field(name: str, members: _Leaves) -> Column:
    places = {steps[0].place for steps, _ in members}
    if len(places) > 1 and (None in places or EVERY in places):
        raise ValueError(f"{name!r} is mapped both as a whole and by its elements")
    if places == {EVERY}:
        return _elements(name, members)
    if places == {None}:
        return _value(name, members)
    at = {k: [m for m in members if m[0][0].place == k] for k in places}
    shapes = {_shape(part) for part in at.values()}
    values = [_value(name, at[k]) if k in at else F.lit(None) for k in range(max(at) + 1)]
    if len(shapes) > 1:  # elements of different fields
        values = [_variant(v, at.get(k)) for k, v in enumerate(values)]
    return F.array(*values)


def _ends(name: str, members: _Leaves) -> bool:
    ends = [len(steps) == 1 for steps, _ in members]
    if any(ends) and not all(ends):
        raise ValueError(f"{name!r} is mapped both to a value and to fields below it")
    return all(ends)


def _value(name: str, members: _Leaves) -> Column:
    if _ends(name, members):
        return members[-1][1].one()
    return _record([(steps[1:], leaf) for steps, leaf in members])


def _elements(name: str, members: _Leaves) -> Column:
    """A list: of values, or of records zipped by position."""
    if _ends(name, members):
        values = members[-1][1].all()
        return F.when(F.size(values) > 0, values)
    zipped = F.arrays_zip(*[leaf.all().alias(f"f{k}") for k, (_, leaf) in enumerate(members)])

    def record(element: Column) -> Column:
        return _plain([(steps[1:], element.getField(f"f{k}")) for k, (steps, _) in enumerate(members)])
    return F.when(F.size(zipped) > 0, F.transform(zipped, record))


def _plain(values: list[tuple[tuple[Step, ...], Column]]) -> Column:
    """A struct of columns by the names of their paths; lists inside lists are not told apart from values."""
    fields: dict[str, list] = {}
    for steps, value in values:
        fields.setdefault(steps[0].name, []).append((steps[1:], value))
    return F.struct(*[(_plain(below) if below[0][0] else below[-1][1]).alias(name) for name, below in sorted(fields.items())])


def _shape(members: _Leaves) -> tuple:
    return tuple(sorted((tuple((s.name, s.place) for s in steps[1:]), leaf.shape) for steps, leaf in members))


def _variant(value: Column, members: _Leaves | None) -> Column:
    if members is None or len(members[0][0]) == 1:
        return value.cast("variant")
    return F.to_variant_object(value)


def _capture(headers: Sequence[str], profile: Mapping[str, Mapping]) -> Column:
    """Cells without a target, names in order, empty ones left out."""
    if not headers:
        return F.create_map().cast("map<string,string>")
    names = sorted(headers)
    values = [coerce(F.col(f"`{h}`"), profile.get(h, {}).get("kind", "string"),
                     profile.get(h, {}).get("number_locale", "en")) for h in names]
    pairs = F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*values))
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def capture_unmapped(df: DataFrame, mapping: Mapping[str, str | None],
                     profile: Mapping[str, Mapping] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    loose = [c for c in df.columns if c not in keep and not _is_mapped(mapping.get(c))]
    return clean_table(df, keep).select(*keep, _capture(loose, profile or {}).alias("_unmapped"))


def misaligned_lists(df: DataFrame, mapping: Mapping[str, str | None],
                     profile: Mapping[str, Mapping] | None = None,
                     value_map: Mapping[str, Mapping] | None = None) -> DataFrame:
    """List prefixes whose columns give lists of different length, with row counts."""
    profile, value_map = profile or {}, value_map or {}
    df = clean_table(df)
    groups: dict[str, list[str]] = {}
    for h, p in mapping.items():
        if _is_mapped(p) and every_prefix(str(p)):
            groups.setdefault(every_prefix(str(p)), []).append(h)
    counts = []
    for prefix, headers in sorted(groups.items()):
        sizes = F.filter(F.array(*[F.size(pieces(F.col(f"`{h}`"), profile.get(h, {}), value_map.get(mapping[h], {})))
                                   for h in headers]), lambda s: s > 0)
        counts.append(F.struct(F.lit(prefix).alias("prefix"),
                               F.count_if(F.size(F.array_distinct(sizes)) > 1).alias("rows")))
    return (df.agg(F.array(*counts).alias("c")).select(F.inline("c")).where(F.col("rows") > 0))


# -------------------------------------------------------------------- ids

def assign_ids(df: DataFrame, key: str, row: str, id_map: DataFrame | None = None) -> DataFrame:
    """Add ``source_key`` and a stable ``project_id``.

    A key in ``id_map`` keeps its id. Others get their slug; a slug that
    several keys share is numbered ``-2``, ``-3`` ... in row order, past the
    ids already taken. Rows without a key are keyed by their row number.
    """
    raw = X.clean_cell(F.col(f"`{key}`"))
    rows = df.withColumn("source_key", F.coalesce(raw, F.concat(F.lit("__row_"), F.col(row).cast("string"))))
    slug = X.slugify(F.coalesce(raw, F.concat(F.lit(f"{NO_ID}-"), F.col(row).cast("string"))), "-")
    slug = F.regexp_replace(F.substring(slug, 1, ID_WIDTH), "^-+|-+$", "")
    slug = F.when(slug == "", F.lit(NO_ID)).otherwise(slug)
    keys = (rows.groupBy("source_key")
            .agg(F.min(row).alias("_row"), F.min_by(slug, F.col(row)).alias("_slug"),
                 F.count(F.lit(1)).alias("_n")))
    if id_map is None:
        ids = number_slugs(keys)
    else:
        known = keys.join(id_map.select("source_key", "project_id"), "source_key")
        fresh = keys.join(id_map, "source_key", "left_anti")
        ids = number_slugs(fresh, id_map).unionByName(known.select("source_key", "project_id"))
    weighed = ids.join(keys.select("source_key", "_n"), "source_key")
    return attach_by_key(rows, weighed, ["source_key"], weight="_n")


def number_slugs(keys: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Ids for new keys (source_key, _slug, _row): slug, slug-2, slug-3 ...

    Numbers count up in row order and skip ids in ``taken`` and ids that are
    themselves the slug of another key. The m-th key of a slug gets the m-th
    free number: keys and used numbers are merged into one ordering, and the
    place in it is the number. No slug is gathered into one task.
    """
    numbered = row_numbers(keys.select("source_key", "_slug", "_row"), ["_row"], ["_slug"], "_m")
    suffixed = r"^(.*)-([1-9]\d*)$"
    claims = keys.select(F.col("_slug").alias("id"), F.lit(False).alias("fixed"))
    if taken is not None:
        claims = claims.unionByName(taken.select(F.col("project_id").alias("id"), F.lit(True).alias("fixed")))
    plain = claims.where("fixed").select(F.col("id").alias("_slug"), F.lit(1).cast("bigint").alias("_k"))
    after = (claims.where(F.col("id").rlike(suffixed))
             .select(F.regexp_extract("id", suffixed, 1).alias("_slug"),
                     F.regexp_extract("id", suffixed, 2).try_cast("bigint").alias("_k"))
             .where(F.col("_k") >= 2))
    used = plain.unionByName(after).distinct().join(keys.select("_slug").distinct(), "_slug", "left_semi")
    used = row_numbers(used, ["_k"], ["_slug"], "_i")
    # Numbers 1.._k-1 hold _k - _i free ones: a used number lies behind them.
    both = numbered.select("_slug", "source_key", F.col("_m").cast("double").alias("_pos"),
                             F.lit(0).cast("bigint").alias("_k")).unionByName(
        used.select("_slug", F.lit(None).cast("string").alias("source_key"),
                    (F.col("_k") - F.col("_i") + 0.5).alias("_pos"), "_k"))
    # Consecutive used numbers share a position: the number itself spreads them over ranges.
    placed = row_numbers(both, ["_pos", "_k"], ["_slug"], "_n").where(F.col("source_key").isNotNull())
    return placed.select("source_key", F.when(F.col("_n") == 1, F.col("_slug")).otherwise(
        F.concat("_slug", F.lit("-"), F.col("_n").cast("string"))).alias("project_id"))


def id_collisions(ids: DataFrame, slug: str = "slug") -> DataFrame:
    """Slugs that more than one key produced."""
    return (ids.groupBy(slug).agg(F.countDistinct("source_key").alias("keys"))
            .where(F.col("keys") > 1))


# ------------------------------------------------------- change detection

def stamp_meta(df: DataFrame, source: str, sheet: str, row: str, imported_at: str) -> DataFrame:
    """Add ``_meta``: where a record came from and that nobody checked it yet."""
    return df.withColumn("_meta", F.struct(
        F.lit(source).alias("source"), F.lit(sheet).alias("source_sheet"),
        F.col(row).cast("bigint").alias("source_row"), F.lit(imported_at).alias("imported_at"),
        F.lit("imported").alias("confidence"), F.lit(None).cast("string").alias("last_reviewed"),
        F.lit(None).cast("string").alias("reviewed_by")))


def content_hash(df: DataFrame, exclude: Sequence[str] = ("_meta",)) -> Column:
    columns = sorted(c for c in df.columns if c not in exclude)
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256)


def diff_records(new: DataFrame, old: DataFrame, key: str = "project_id") -> DataFrame:
    """Compare a new run with the stored records, ``_meta`` aside.

    Gives ``state`` (new, changed, unchanged, removed) and the ``_meta`` to
    store: review marks survive, and an unchanged record also keeps its old
    import date and confidence.
    """
    left = new.select(key, F.col("_meta").alias("_new"), content_hash(new).alias("_h1"))
    right = old.select(key, F.col("_meta").alias("_old"), content_hash(old).alias("_h2"))
    both = left.join(right, key, "full_outer")
    same = F.col("_h1") == F.col("_h2")
    state = (F.when(F.col("_h2").isNull(), F.lit("new")).when(F.col("_h1").isNull(), F.lit("removed"))
              .when(same, F.lit("unchanged")).otherwise(F.lit("changed")))
    m, o = F.col("_new"), F.col("_old")
    meta = F.when(m.isNull(), o).otherwise(F.struct(
        m["source"].alias("source"), m["source_sheet"].alias("source_sheet"),
        m["source_row"].alias("source_row"),
        F.when(same, F.coalesce(o["imported_at"], m["imported_at"])).otherwise(m["imported_at"]).alias("imported_at"),
        F.when(same, F.coalesce(o["confidence"], m["confidence"])).otherwise(m["confidence"]).alias("confidence"),
        F.coalesce(o["last_reviewed"], m["last_reviewed"]).alias("last_reviewed"),
        F.coalesce(o["reviewed_by"], m["reviewed_by"]).alias("reviewed_by")))
    return both.select(key, state.alias("state"), meta.alias("_meta"))


# ----------------------------------------------------------------- report

def conversion_report(df: DataFrame, mapping: Mapping[str, str | None],
                      profile: Mapping[str, Mapping] | None = None,
                      value_map: Mapping[str, Mapping] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Per target path the records filled, per unmapped column the cells kept.

    One pass over the table: every figure is a column of one aggregate.
    """
    profile, value_map = profile or {}, value_map or {}
    df = clean_table(df, keep)
    headers = [c for c in df.columns if c not in keep]
    figures, has = [], F.lit(False)
    for h in headers:
        path = mapping.get(h)
        cell = F.col(f"`{h}`")
        if _is_mapped(path):
            hit = F.size(pieces(cell, profile.get(h, {}), value_map.get(path, {}))) > 0
            section, name = "field", path
        else:
            hit = cell.isNotNull()
            section, name = "unmapped", h
        has = has | hit
        figures.append((section, name, hit))
    rows = F.count_if(has)
    stats = df.agg(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"),
                                      F.count_if(hit).alias("n")) for s, n, hit in figures]).alias("f"),
                   rows.alias("records"), F.count(F.lit(1)).alias("rows_read"))
    return (stats.select(F.inline("f"), "records", "rows_read")
            .groupBy("section", "name").agg(F.sum("n").alias("n"), F.max("records").alias("records"),
                                            F.max("rows_read").alias("rows_read"))
            .withColumn("pct", N.percent("n", "records")))


def coercion_failures(df: DataFrame, profile: Mapping[str, Mapping], samples: int = 8) -> DataFrame:
    """Cells that could not be read as their column's kind, with some examples."""
    checked = {h: p for h, p in profile.items() if p.get("kind") in ("date", "integer", "number") and h in df.columns}
    if not checked:
        return df.sparkSession.createDataFrame([], "column string, cells bigint, samples array<string>")
    df = clean_table(df.select(*[F.col(f"`{h}`") for h in checked]))
    cells = df.select(*[F.when(coercion_failed(F.col(f"`{h}`"), p["kind"], p.get("number_locale", "en")),
                               F.col(f"`{h}`")).alias(h) for h, p in checked.items()])
    failed = (cells.unpivot([], list(checked), "column", "value").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    rank = F.row_number().over(W.partitionBy("column").orderBy("value"))
    shown = (failed.withColumn("_r", rank).where(F.col("_r") <= samples).groupBy("column")
             .agg(F.array_sort(F.collect_list("value")).alias("samples")))
    return (failed.groupBy("column").agg(F.sum("n").alias("cells"))
            .join(F.broadcast(shown), "column"))


def new_values(values: DataFrame, dims: DataFrame, group: str) -> DataFrame:
    """Values (column ``value``) that are not codes of their group yet."""
    codes = dims.where(F.col("group") == group).select(F.col("code").alias("value"))
    return (values.where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
            .join(small_side(codes), "value", "left_anti"))


def new_columns(headers: Sequence[str], mapping: Mapping[str, str | None]) -> list[str]:
    return sorted(h for h in headers if h not in mapping)


def check_mapping(headers: Sequence[str], mapping: Mapping[str, str | None]) -> list[tuple[str, str | None]]:
    """Mapped headers the data does not have, each with the closest one."""
    import difflib

    missing = [h for h in mapping if h not in headers]
    return [(h, next(iter(difflib.get_close_matches(h, list(headers), n=1)), None)) for h in missing]
