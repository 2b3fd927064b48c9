"""Document checks. Every check returns rows of findings.

    level  code  file  path  message  fix

Structure, codes and references are generated from the schema (see
``apply_checks``); the rest are joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.known import is_known
from ..functions.numbers import percent
from ..functions.similarity import closest_by_edits, closest_word
from ..functions.text import UNKNOWN
from ..schema import (ANNOTATIONS, DATE_SHAPE, ID_SHAPE, SCHEMA_VERSION, VERSION_SHAPE, walk)
from ..session import cut_lineage
from .keyed import attach_by_key, small_side
from .measures import coverage
from .nearest import nearest_words

ERROR, WARNING, INFO = "error", "warning", "info"
FINDING = ("level", "code", "file", "path", "message", "fix")


def finding(df: DataFrame, level: str, code, path, message, fix=None) -> DataFrame:
    wrap = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(F.lit(level).alias("level"), wrap(code).alias("code"), F.col("file"),
                     wrap(path).alias("path"), wrap(message).alias("message"),
                     wrap(fix).cast("string").alias("fix"))


# ----------------------------------------------------------------- places
#
# Checks are generated from the schema: each place gets an expression of its
# own that gives a finding or NULL, and a document becomes the list of its
# findings. That is one narrow pass, and only findings become rows.

@dataclass(frozen=True)
class Place:
    pattern: str
    shape: str                    # scalar | block | records | list | any
    meta: dict
    children: tuple[str, ...] = ()
    required: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.pattern.split(".")[-1].replace("[]", "")


@dataclass(frozen=True)
class Check:
    """``make`` gives a struct or NULL for one value, an array if ``many``."""

    ddl: str
    want: Callable[[Place], bool]
    make: Callable[[Place, Column, str, Column], Column]
    many: bool = False


def _block(pattern: str, kind: T.StructType, meta: dict) -> Place:
    needed = tuple(f.name for f in kind.fields if f.metadata.get("required"))
    return Place(pattern, "block", meta, tuple(kind.names), needed)


def _place_of(f: T.StructField, pattern: str) -> Place:
    kind = f.dataType
    if isinstance(kind, T.StructType):
        return _block(pattern, kind, f.metadata)
    if isinstance(kind, T.ArrayType):
        return Place(pattern, "records" if isinstance(kind.elementType, T.StructType) else "list", f.metadata)
    return Place(pattern, "any" if isinstance(kind, T.MapType) else "scalar", f.metadata)


def _item_of(f: T.StructField, pattern: str) -> Place:
    kind = f.dataType.elementType
    if isinstance(kind, T.StructType):
        return _block(f"{pattern}[]", kind, {})
    return Place(f"{pattern}[]", "scalar", f.metadata.get("item", {}))


def _all_below(schema: T.StructType, pattern: str) -> Iterator[Place]:
    for f in schema.fields:
        below = f"{pattern}.{f.name}" if pattern else f.name
        yield _place_of(f, below)
        if isinstance(f.dataType, T.StructType):
            yield from _all_below(f.dataType, below)
        elif isinstance(f.dataType, T.ArrayType):
            yield from _all_inside(f, below)


def _all_inside(f: T.StructField, pattern: str) -> Iterator[Place]:
    item = _item_of(f, pattern)
    yield item
    if isinstance(f.dataType.elementType, T.StructType):
        yield from _all_below(f.dataType.elementType, item.pattern)


def _wanted(places: Iterable[Place], checks: Sequence[Check]) -> list[Place]:
    return [p for p in places if any(c.want(p) for c in checks)]


def _view_type(schema: T.StructType, pattern: str, checks: Sequence[Check]) -> str | None:
    """The type that reads all wanted scalars below a block in one step, each as it is; NULL where there is none.

    Records have a part in it if nothing but scalars is asked of them."""
    parts = []
    for f in schema.fields:
        below = f"{pattern}.{f.name}" if pattern else f.name
        kind = None
        if isinstance(f.dataType, T.StructType):
            kind = _view_type(f.dataType, below, checks)
        elif isinstance(f.dataType, T.ArrayType):
            wanted = _wanted(_all_inside(f, below), checks)
            if wanted and all(p.shape == "scalar" for p in wanted):
                records = isinstance(f.dataType.elementType, T.StructType)
                kind = f"array<{_view_type(f.dataType.elementType, f'{below}[]', checks) if records else 'variant'}>"
        elif _place_of(f, below).shape == "scalar" and _wanted([_place_of(f, below)], checks):
            kind = "variant"
        if kind:
            parts.append(f"`{f.name.replace('`', '``')}`: {kind}")
    return f"struct<{', '.join(parts)}>" if parts else None


def _run(place: Place, root: Column, at: str, path: Column, checks: Sequence[Check], ones: list, lists: list) -> None:
    for check in checks:
        if check.want(place):
            (lists if check.many else ones).append(check.make(place, root, at, path))


def _below(schema: T.StructType, root: Column, at: str, path: Column | None, pattern: str,
           checks: Sequence[Check], ones: list, lists: list, view: Column | None) -> None:
    """Results of the checks for every place below ``root``.

    Scalars come from the view; ``at`` is the path from ``root``, where all else is read in one step.
    """
    for f in schema.fields:
        below = f"{pattern}.{f.name}" if pattern else f.name
        here = F.lit(below) if path is None else F.concat(path, F.lit(f"{at}.{f.name}"))
        place = _place_of(f, below)
        if _wanted([place], checks):
            if place.shape == "scalar":
                _run(place, view.getField(f.name), "$", here, checks, ones, lists)
            else:
                _run(place, root, f"${at}.{f.name}", here, checks, ones, lists)
        if isinstance(f.dataType, T.StructType):
            inner = view.getField(f.name) if _view_type(f.dataType, below, checks) else None
            _below(f.dataType, root, f"{at}.{f.name}", path, below, checks, ones, lists, inner)
        elif isinstance(f.dataType, T.ArrayType):
            wanted = _wanted(_all_inside(f, below), checks)
            viewed = all(p.shape == "scalar" for p in wanted)
            if wanted:
                elements = view.getField(f.name) if viewed else F.try_variant_get(root, f"${at}.{f.name}", "array<variant>")
                lists.append(F.flatten(F.transform(elements, _each(f, below, here, checks, viewed))))


def _each(f: T.StructField, pattern: str, path: Column, checks: Sequence[Check], viewed: bool) -> Callable[[Column, Column], Column]:
    def results(element: Column, i: Column) -> Column:
        here = F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
        ones: list[Column] = []
        lists: list[Column] = []
        item, kind = _item_of(f, pattern), f.dataType.elementType
        if not isinstance(kind, T.StructType):
            _run(item, element, "$", here, checks, ones, lists)
        elif viewed:
            _below(kind, element, "", here, item.pattern, checks, ones, lists, element)
        else:
            return _block_results(item, kind, element, here, checks)
        return _joined(checks, ones, lists)
    return results


def _block_results(place: Place, schema: T.StructType, root: Column, path: Column | None, checks: Sequence[Check]) -> Column:
    """Results for a block and everything below it."""
    def results(view: Column | None) -> Column:
        ones: list[Column] = []
        lists: list[Column] = []
        _run(place, root, "$", F.lit("") if path is None else path, checks, ones, lists)
        _below(schema, root, "", path, place.pattern, checks, ones, lists, view)
        return _joined(checks, ones, lists)

    kind = _view_type(schema, place.pattern, checks)
    # The list of one view stands for a variable: the view is worked out once, not at each of its places.
    return results(None) if kind is None else F.get(F.transform(F.array(F.try_variant_get(root, "$", kind)), lambda view: results(view)), F.lit(0))


def _joined(checks: Sequence[Check], ones: list, lists: list) -> Column:
    none = F.array().cast(f"array<{checks[0].ddl}>")
    found = F.array_compact(F.array(*ones)) if ones else none
    return F.concat(found, *[F.coalesce(v, none) for v in lists]) if lists else found


def results_of(schema: T.StructType, *checks: Check, column: str = "doc") -> Column:
    """The list of all results of the checks for one document."""
    return _block_results(_block("", schema, {}), schema, F.col(column), None, checks)


def as_rows(docs: DataFrame, results: Column) -> DataFrame:
    """``file`` and the fields of each result."""
    # The outer form keeps Spark from testing the size of the list first, which
    # would read every document twice.
    rows = docs.select("file", F.explode_outer(results).alias("h"))
    return rows.where(F.col("h").isNotNull()).select("file", "h.*")


def apply_checks(docs: DataFrame, schema: T.StructType, *checks: Check, column: str = "doc") -> DataFrame:
    """Rows of all results: ``file`` and the fields of the result."""
    return as_rows(docs, results_of(schema, *checks, column=column))


# ----------------------------------------------------------------- checks

def check_parse(parsed: DataFrame) -> DataFrame:
    """Files that hold no usable document."""
    broken = parsed.where(F.col("code").isNotNull())
    message = F.col("message") if "message" in parsed.columns else F.col("code")
    return finding(broken, ERROR, F.col("code"), F.lit(""), message)


_HIT = "struct<code:string,path:string,message:string,fix:string>"


def _hit(code, path, message, fix=None) -> Column:
    wrap = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(wrap(code).alias("code"), wrap(path).alias("path"), wrap(message).alias("message"),
                    wrap(fix).cast("string").alias("fix"))


# What is inside a block or list is not read where only its keys or its shape count: hardly a value is of this type,
# so each is NULL at once and nothing is copied.
_UNREAD = "array<array<boolean>>"


def _keys(root: Column, at: str) -> Column:
    return F.map_keys(F.try_variant_get(root, at, f"map<string,{_UNREAD}>"))


def _value(root: Column, at: str) -> Column:
    return root if at == "$" else F.try_variant_get(root, at, "variant")


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def unknown_field_check() -> Check:
    def make(place: Place, root: Column, at: str, path: Column) -> Column:
        def hit(key: Column) -> Column:
            where = key if not place.pattern else F.concat_ws(".", path, key)
            return _hit("structure.unknown-field", where, F.concat(F.lit("unknown field '"), key, F.lit("'")),
                        F.concat(F.lit("did you mean: "), closest_by_edits(key, sorted(place.children))))
        return F.transform(F.array_except(_keys(root, at), _texts(place.children)), hit)
    return Check(_HIT, lambda p: p.shape == "block" and not p.meta.get("open"), make, many=True)


def required_check() -> Check:
    def make(place: Place, root: Column, at: str, path: Column) -> Column:
        def hit(key: Column) -> Column:
            fix = (F.concat(F.lit("every document needs "), key) if not place.pattern else F.concat(
                path, F.lit("."), key, F.lit(" is required whenever "), path, F.lit(" is present")))
            return _hit("structure.missing-field", path, F.concat(F.lit("missing required field '"), key, F.lit("'")), fix)
        return F.transform(F.array_except(_texts(place.required), _keys(root, at)), hit)
    return Check(_HIT, lambda p: p.shape == "block" and bool(p.required), make, many=True)


def type_check() -> Check:
    def make(place: Place, root: Column, at: str, path: Column) -> Column:
        kind = place.meta.get("kind")
        shape = _shape(place, root, at)
        fault = type_fault(shape, F.try_variant_get(root, at, "string"), place)
        expected = f"{place.name}: expected {kind or place.shape}, got "
        return F.when(fault.isNotNull(), _hit(F.concat(F.lit("structure."), fault), path,
                                              F.concat(F.lit(expected), F.lower(shape))))
    # Places of any content are exempt.
    return Check(_HIT, lambda p: p.pattern != "" and p.shape != "any", make)


def _shape(place: Place, root: Column, at: str) -> Column:
    """ARRAY, OBJECT or the scalar type of a value; NULL where there is none.

    The printed schema of a whole block or list is as long as its content, so
    places that hold one are first asked whether they are what they should be."""
    printed = F.substring_index(F.schema_of_variant(_value(root, at)), "<", 1)
    if place.shape == "block":
        return F.when(F.try_variant_get(root, at, "struct<>").isNotNull(), F.lit("OBJECT")).otherwise(printed)
    if place.shape in ("list", "records"):
        return F.when(F.try_variant_get(root, at, f"array<{_UNREAD}>").isNotNull(), F.lit("ARRAY")).otherwise(printed)
    return printed


def _structure(docs: DataFrame, schema: T.StructType, *checks: Check) -> DataFrame:
    rows = apply_checks(docs, schema, *checks)
    return rows.select(F.lit(ERROR).alias("level"), "code", "file", "path", "message", "fix")


def check_unknown_fields(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Keys the schema does not know, at any level, with the closest name that is valid there."""
    return _structure(docs, schema, unknown_field_check())


def check_required(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Required keys missing from the root or from a block that is present."""
    return _structure(docs, schema, required_check())


def check_types(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Type, pattern, constant and minimum, by the kind of each field."""
    return _structure(docs, schema, type_check())


def check_structure(docs: DataFrame, schema: T.StructType) -> DataFrame:
    """The three checks above in one pass."""
    return _structure(docs, schema, unknown_field_check(), required_check(), type_check())


def type_fault(shape: Column, text: Column, place: Place) -> Column:
    """What is wrong with one value: type, pattern, anyOf, const, or NULL.

    A value that is absent has no shape and no fault.
    """
    kind = place.meta.get("kind")
    if place.shape in ("list", "records", "block", "any"):
        fine = {"list": ("ARRAY", "VOID"), "records": ("ARRAY", "VOID"), "block": ("OBJECT",), "any": ("OBJECT", "VOID")}
        return F.when(~shape.isin(*fine[place.shape]), F.lit("type"))
    patterns = {"version": VERSION_SHAPE, "date": DATE_SHAPE, "id": ID_SHAPE}
    if kind == "count":
        good = (((shape == "BIGINT") & (text.try_cast("bigint") >= 0)) | (shape == "VOID")
                | ((shape == "STRING") & (text == UNKNOWN)))
        return F.when(shape.isNotNull() & ~F.coalesce(good, F.lit(False)), F.lit("anyOf"))
    if kind == "schema_version":
        return F.when(shape.isNotNull() & ~F.coalesce((shape == "BIGINT") & (text == str(SCHEMA_VERSION)), F.lit(False)),
                      F.lit("const"))
    wrong = ~shape.isin("STRING") if kind == "id" else ~shape.isin("STRING", "VOID")
    fault = F.when(wrong, F.lit("type"))
    if kind in patterns:
        fault = fault.when((shape == "STRING") & ~text.rlike(patterns[kind]), F.lit("pattern"))
    return fault


_LEAF = "struct<path:string,pattern:string,taxonomy:string,ref:string,value:string>"


def _is_answer(root: Column, at: str) -> Column:
    """A text, and an actual answer."""
    return (F.schema_of_variant(_value(root, at)) == "STRING") & is_known(F.try_variant_get(root, at, "string"))


def leaf_check(refs: Sequence[str] | None = None) -> Check:
    """Known text values that must be a code or exist elsewhere."""
    def want(place: Place) -> bool:
        if place.shape != "scalar":
            return False
        if refs is not None:
            return place.meta.get("ref") in refs
        return bool(place.meta.get("taxonomy") or place.meta.get("ref"))

    def make(place: Place, root: Column, at: str, path: Column) -> Column:
        return F.when(_is_answer(root, at), F.struct(
            path.alias("path"), F.lit(place.pattern).alias("pattern"),
            F.lit(place.meta.get("taxonomy")).cast("string").alias("taxonomy"),
            F.lit(place.meta.get("ref")).cast("string").alias("ref"), F.try_variant_get(root, at, "string").alias("value")))

    return Check(_LEAF, want, make)


_TOLD = "struct<level:string,code:string,path:string,message:string,fix:string,source:string,group:string,value:string>"


def _told(**fields: Column) -> Column:
    """A finding, or a value to look up: what is not given is NULL."""
    return F.struct(*[fields.get(n, F.lit(None).cast("string")).alias(n) for n in (
        "level", "code", "path", "message", "fix", "source", "group", "value")])


def _asking_check(annotation: str) -> Check:
    """As ``leaf_check``, for the values that one annotation (taxonomy or ref) sends to a list, with the name of the list."""
    def make(place: Place, root: Column, at: str, path: Column) -> Column:
        group = place.meta[annotation]
        source = "taxonomy" if annotation == "taxonomy" else _source_of_ref(group)
        return F.when(_is_answer(root, at), _told(path=path, source=F.lit(source), group=F.lit(group), value=F.try_variant_get(root, at, "string")))
    return Check(_TOLD, lambda p: p.shape == "scalar" and bool(p.meta.get(annotation)), make)


def _source_of_ref(ref: str) -> str:
    """The ids of documents are a source of their own."""
    return "projects" if ref == "projects" else "reference"


def coded_leaves(docs: DataFrame, schema: T.StructType, refs: Sequence[str] | None = None) -> DataFrame:
    """Rows of the values above. ``refs`` limits them to the fields that point
    at those lists; only fields that are asked for are read."""
    return apply_checks(docs, schema, leaf_check(refs))


def _leaf_name(path: str = "path") -> Column:
    return F.regexp_replace(F.substring_index(path, ".", -1), r"\[\d+\]$", "")


def _pointers(taxonomy: Column, ref: Column) -> Column:
    """The lists (source, group) that a value has to be in. The ids of documents are a source of their own."""
    return F.array_compact(F.array(
        F.when(taxonomy.isNotNull(), F.struct(F.lit("taxonomy").alias("source"), taxonomy.alias("group"))),
        F.when(ref.isNotNull(), F.struct(F.when(ref == "projects", ref).otherwise(F.lit("reference")).alias("source"), ref.alias("group")))))


def _codes(dims: DataFrame) -> DataFrame:
    return dims.select("source", "group", F.col("code").alias("value"))


def check_lists(leaves: DataFrame, dims: DataFrame, source: str | None = None) -> DataFrame:
    """Values that are in neither their taxonomy group nor their reference
    list. Both are anti joins against the same dimension, in one pass; the wrong
    values are written once, so nothing is looked up where none is wrong."""
    codes = _codes(dims)
    if source:
        group = "taxonomy" if source == "taxonomy" else "ref"
        rows = leaves.where(F.col(group).isNotNull()).select("file", "path", "value", F.lit(source).alias("source"), F.col(group).alias("group"))
        rows, codes = rows.where("source = 'taxonomy' OR group <> 'projects'"), codes.where(F.col("source") == source)
    else:
        rows = leaves.select("file", "path", "value", F.explode(_pointers(F.col("taxonomy"), F.col("ref"))).alias("w")).select(
            "file", "path", "value", "w.*").where("source <> 'projects'")
    return _wrong_values(cut_lineage(rows.join(small_side(codes), ["source", "group", "value"], "left_anti")), codes)


def _wrong_values(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Findings for values that are not in their list, with the closest code or all of them."""
    # Each different wrong value is looked up once among the codes of its own list.
    lists = codes.groupBy("source", "group").agg(F.array_sort(F.collect_set("value")).alias("words"))
    wrong = rows.groupBy("source", "group", "value").agg(F.count(F.lit(1)).alias("_n")).join(small_side(lists), ["source", "group"], "left")
    best = closest_word(F.col("value"), F.col("words"))
    fix = F.coalesce(F.concat(F.lit("did you mean: "), best), F.concat(F.lit("valid values: "), F.array_join("words", ", ")))
    rows = attach_by_key(rows, wrong.select("source", "group", "value", fix.alias("fix"), "_n"), ["source", "group", "value"], weight="_n")
    coded = F.col("source") == "taxonomy"
    return finding(rows, ERROR, F.when(coded, F.lit("ref.unknown-code")).otherwise(F.concat(F.lit("ref.unknown-"), "group")),
                   F.col("path"), F.concat(_leaf_name(), F.lit(": '"), "value", F.when(coded, F.lit("' is not a known code"))
                                           .otherwise(F.concat(F.lit("' is not in "), "group"))), F.col("fix"))


def check_codes(leaves: DataFrame, dims: DataFrame) -> DataFrame:
    """Values that are no code of their group; lists element by element."""
    return check_lists(leaves, dims, "taxonomy")


def check_references(leaves: DataFrame, dims: DataFrame, ids: DataFrame) -> DataFrame:
    """Values missing from a reference list, or naming no existing document."""
    return check_lists(leaves, dims, "reference").unionByName(check_dangling(leaves, ids))


def check_dangling(leaves: DataFrame, ids: DataFrame) -> DataFrame:
    """Dependencies on documents that do not exist.

    Targets are reduced to distinct values before they meet the ids, so a
    target named by every document is looked up once. A missing one comes with the
    closest id there is (see ``nearest_words``).
    """
    edges = leaves.where(F.col("ref") == "projects").select("file", "path", "value")
    targets = edges.groupBy("value").agg(F.count(F.lit(1)).alias("_n"))
    missing = targets.join(ids.select(F.col(ids.columns[0]).alias("value")).distinct(), "value", "left_anti")
    missing = cut_lineage(missing)
    missing = missing.join(nearest_words(missing.select("value"), ids), "value", "left")
    rows = attach_by_key(edges, missing, ["value"], weight="_n")
    return finding(rows, ERROR, "ref.unknown-projects", F.col("path"),
                   F.concat(_leaf_name(), F.lit(": depends on '"), "value", F.lit("', which is not a known project")),
                   F.concat(F.lit("did you mean: "), "near"))


def check_duplicate_ids(ids: DataFrame) -> DataFrame:
    """The second and later file with an id, naming the first (id, file)."""
    used = ids.where(F.coalesce(F.col("id"), F.lit("")) != "")
    shared = (used.groupBy("id").agg(F.min("file").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1))
    rows = attach_by_key(used, shared, ["id"], weight="_n").where(F.col("file") != F.col("_first"))
    return finding(rows, ERROR, "ref.duplicate-id", "id",
                   F.concat(F.lit("project id '"), "id", F.lit("' is also used by "), "_first"))


def check_documents(docs: DataFrame, schema: T.StructType, dims: DataFrame, ids: DataFrame,
                    rules: Sequence[Column] = ()) -> DataFrame:
    """Structure, codes, references and rules in one pass over the documents.

    A document becomes one tagged list: its structure findings, its rule hits
    (``rules``, see ``Rules.hits``) and its values to look up. Values that are
    in their list go before anything is written; the rest is written once.
    """
    told = lambda level, h: _told(level=level, code=h["code"], path=h["path"], message=h["message"], fix=h["fix"])
    structure = F.transform(results_of(schema, unknown_field_check(), required_check(), type_check()),
                            lambda h: told(F.lit(ERROR), h))
    looked_up = results_of(schema, _asking_check("taxonomy"), _asking_check("ref"))
    hits = [F.transform(F.array_compact(F.array(*rules)), lambda h: told(h["level"], h))] if rules else []
    # Rows without a list get their file as group, so that a shuffle join spreads them.
    rows = as_rows(docs, F.concat(structure, looked_up, *hits)).withColumn("group", F.coalesce("group", "file"))
    codes = _codes(dims)
    rows = cut_lineage(rows.join(small_side(codes), ["source", "group", "value"], "left_anti"))
    values = rows.where("level IS NULL").select("file", "path", "source", "group", "value")
    pointing = values.where("source = 'projects'").select("file", "path", "value", F.lit("projects").alias("ref"))
    return union_findings(rows.where("level IS NOT NULL").select(*FINDING),
                          _wrong_values(values.where("source <> 'projects'"), codes), check_dangling(pointing, ids))


# ---------------------------------------------------------------- reports

def level_order(level="level") -> Column:
    return (F.when(F.col(level) == ERROR, 0).when(F.col(level) == WARNING, 1)
             .when(F.col(level) == INFO, 2).otherwise(3))


def union_findings(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def order_findings(findings: DataFrame) -> DataFrame:
    """By file, place, severity, code."""
    place = [F.col(c) for c in ("line", "col") if c in findings.columns] or [F.col("path")]
    return findings.orderBy(F.coalesce("file", F.lit("")), *place, level_order(), "code", "message")


def summarise(findings: DataFrame, strict: bool = False) -> DataFrame:
    """Counts per level and the verdict (0 ok, 1 invalid)."""
    counts = findings.agg(*[F.count_if(F.col("level") == lv).alias(f"{lv}s") for lv in (ERROR, WARNING, INFO)])
    bad = (F.col("errors") > 0) | (F.lit(strict) & (F.col("warnings") > 0))
    return counts.withColumn("verdict", F.when(bad, F.lit("invalid")).otherwise(F.lit("ok")))


def findings_by_code(findings: DataFrame) -> DataFrame:
    return findings.groupBy("level", "code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files"))


def attach_positions(findings: DataFrame, positions: DataFrame) -> DataFrame:
    """Add line and column; a place that is not in the file takes its nearest
    ancestor's. An unknown field points at its key."""
    steps = F.split(F.regexp_replace("path", r"\[", ".["), r"\.")
    rooted = F.when(F.col("path") == "", F.array(F.lit(""))).otherwise(F.concat(
        F.array(F.lit("")),
        F.transform(F.sequence(F.lit(1), F.size(steps)),
                    lambda i: F.regexp_replace(F.array_join(F.slice(steps, F.lit(1), i), "."), r"\.\[", "["))))
    named = F.col("code") == "structure.unknown-field"
    prefixes = F.when(named, F.concat(rooted, F.array(F.concat("path", F.lit("!"))))).otherwise(rooted)
    keyed = findings.withColumn("_prefix", F.explode(prefixes))
    found = keyed.join(positions.withColumnRenamed("path", "_prefix"), ["file", "_prefix"], "left")
    best = F.max_by(F.struct("line", "col"), F.when(F.col("line").isNotNull(), F.length("_prefix")))
    return (found.groupBy(*FINDING).agg(best.alias("_at"))
            .select(*FINDING, F.coalesce("_at.line", F.lit(1)).alias("line"),
                    F.coalesce("_at.col", F.lit(1)).alias("col")))


def coverage_report(projects: DataFrame, team: str = "team_id", confidence: str = "confidence") -> DataFrame:
    """Filled and verified share per team and in total, as the report model gives them."""
    return coverage(projects, team, confidence)


def coverage_by_project(projects: DataFrame) -> DataFrame:
    return projects.select("project_id", "file", "fields_filled", "fields_tracked",
                           percent("fields_filled", "fields_tracked").alias("coverage_pct"))


# ---------------------------------------------------------- schema self-test

def check_schema(dims: DataFrame, orders: DataFrame, schema: T.StructType,
                 provisional: Sequence[str] = ()) -> DataFrame:
    """Faults of the schema and the code lists themselves.

    ``dims`` holds the codes, ``orders`` the declared order (group, code).
    """
    spark = dims.sparkSession
    taxonomy = dims.where(F.col("source") == "taxonomy")
    codes = taxonomy.select("group", "code")
    file = F.lit("taxonomy").alias("file")
    lost = finding(codes.exceptAll(orders.select("group", "code")).withColumn("file", file), ERROR,
                   "schema.code-not-in-order", F.concat_ws("/", "group", "code"), F.lit("code is missing from the order"))
    extra = finding(orders.select("group", "code").exceptAll(codes).withColumn("file", file), ERROR,
                    "schema.order-not-a-code", F.concat_ws("/", "group", "code"), F.lit("the order lists no such code"))
    groups = codes.groupBy("group").agg(F.bool_or(F.col("code") == UNKNOWN).alias("_u")).where(~F.col("_u"))
    silent = finding(groups.withColumn("file", file), WARNING, "schema.no-unknown-code", F.col("group"),
                     F.lit("the group has no unknown code"))
    bare = (taxonomy.where(F.col("label_de").isNull()).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 0).withColumn("file", file))
    unlabelled = finding(bare, WARNING, "schema.unlabelled-codes", F.lit(""),
                         F.concat(F.col("_n").cast("string"), F.lit(" code(s) have no German label")))
    known_groups = {r["group"] for r in codes.select("group").distinct().collect()}
    known_refs = {r["group"] for r in dims.where(F.col("source") == "reference").select("group").distinct().collect()}
    own, tracked = [], 0
    for node in walk(schema):
        meta = {**node.meta}
        tracked += bool(meta.get("tracked"))
        for key in meta:
            if key not in (*ANNOTATIONS, "item"):
                own.append((ERROR, "schema.unknown-annotation", node.pattern, f"unknown annotation {key!r}"))
        if meta.get("taxonomy") and meta["taxonomy"] not in known_groups:
            own.append((ERROR, "schema.unknown-taxonomy-group", node.pattern, f"no group {meta['taxonomy']!r}"))
        if meta.get("ref") and meta["ref"] not in known_refs | {"projects"}:
            own.append((ERROR, "schema.unknown-ref-source", node.pattern, f"no reference list {meta['ref']!r}"))
        if meta.get("column") and "[]" in node.pattern:
            own.append((ERROR, "schema.column-on-repeated-field", node.pattern, "column on a field inside a list"))
    if not tracked:
        own.append((WARNING, "schema.nothing-tracked", "", "no field is tracked, coverage would always be 0"))
    own += [(WARNING, "schema.provisional-reference", p, "the list is marked provisional") for p in provisional]
    fixed = spark.createDataFrame([(lv, c, "schema", p, m, None) for lv, c, p, m in own],
                                  "level string, code string, file string, path string, message string, fix string")
    return union_findings(lost, extra, silent, unlabelled, fixed)
