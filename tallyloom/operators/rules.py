"""Plausibility rules: pairs of columns, all evaluated in one scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.known import is_known
from ..functions.paths import Paths
from ..functions.text import first_text
from .validate import FINDING, WARNING, as_rows

# Fixed values of the shipped rules.
LONG_RTO_HOURS = 168
PROD_NAMES = ("prod", "produktion", "production")


@dataclass(frozen=True)
class Rule:
    code: str
    level: str
    path: str
    when: Callable[[Paths], Column]
    message: Callable[[Paths], Column]


@dataclass
class Rules:
    """A registry of rules; users add their own with ``register``."""

    rules: list[Rule] = field(default_factory=list)

    def register(self, code: str, path: str, when: Callable[[Paths], Column],
                 message: Callable[[Paths], Column] | str, level: str = WARNING) -> "Rules":
        text = message if callable(message) else (lambda _: F.lit(message))
        self.rules.append(Rule(code, level, path, when, text))
        return self

    def hits(self, docs: DataFrame, column: str = "doc") -> tuple[list[Column], DataFrame]:
        """A hit or NULL for each rule, as columns, and the warnings for rules
        that cannot be built for these documents."""
        paths = Paths(docs, column)
        hits, crashed = [], []
        for rule in self.rules:
            try:
                when = F.coalesce(rule.when(paths), F.lit(False))
                hit = F.when(when, F.struct(F.lit(rule.level).alias("level"), F.lit(rule.code).alias("code"),
                                            F.lit(rule.path).alias("path"), rule.message(paths).alias("message"),
                                            F.lit(None).cast("string").alias("fix")))
                docs.select(hit)  # resolves the columns now, without running anything
                hits.append(hit)
            except Exception as broken:  # a broken rule must not fail the run
                crashed.append((WARNING, "plausible.rule-crashed", None, "",
                                f"plausibility rule {rule.code!r} crashed: {type(broken).__name__}", None))
        ddl = "level string, code string, file string, path string, message string, fix string"
        return hits, docs.sparkSession.createDataFrame(crashed, ddl)

    def apply(self, docs: DataFrame, column: str = "doc") -> DataFrame:
        """Findings of all rules, one pass over the documents."""
        hits, out = self.hits(docs, column)
        if hits:
            out = as_rows(docs, F.array_compact(F.array(*hits))).select(*FINDING).unionByName(out)
        return out.select(*FINDING)


def _environment_names(p: Paths) -> Column:
    names = F.transform(p.items("placement.environments"), lambda e: F.lower(p.inside(e, "name")))
    return F.filter(names, lambda n: F.coalesce(n, F.lit("")) != "")


def _open_blockers(p: Paths) -> Column:
    still = F.filter(p.items("migration.blockers"), lambda b: p.inside(b, "status") == "open")
    return F.transform(still, lambda b: F.coalesce(first_text(p.inside(b, "id")), F.lit("?")))


def container_not_containerised(p: Paths) -> Column:
    return (p.text("platform.deployment_model") == "container") & (p.text("platform.containerised") == "none")


def tier1_long_rto(p: Paths) -> Column:
    return (p.text("operations.tier") == "tier-1") & (p.whole("operations.rto_hours") >= LONG_RTO_HOURS)


def storage_class_without_size(p: Paths) -> Column:
    return (F.size(p.texts("platform.storage_classes")) > 0) & (p.whole("platform.storage_gb") == 0)


def no_prod_environment(p: Paths) -> Column:
    names = _environment_names(p)
    return (F.size(names) > 0) & ~F.arrays_overlap(names, F.array(*map(F.lit, PROD_NAMES)))


def migrated_with_open_blockers(p: Paths) -> Column:
    return (p.text("migration.status") == "migrated") & (F.size(_open_blockers(p)) > 0)


def both_placement_shapes(p: Paths) -> Column:
    return (F.coalesce(p.text("placement.datacenter"), F.lit("")) != "") & (
        F.size(p.items("placement.environments")) > 0)


def verified_without_review(p: Paths) -> Column:
    return (p.text("_meta.confidence") == "verified") & (
        F.coalesce(p.text("_meta.last_reviewed"), F.lit("")) == "")


def shipped_rules() -> Rules:
    """The seven rules every run has."""
    return (Rules()
            .register("plausible.container-not-containerised", "platform.containerised",
                      container_not_containerised, "deployment_model is 'container' but containerised is 'none'")
            .register("plausible.tier1-long-rto", "operations.rto_hours", tier1_long_rto,
                      lambda p: F.concat(F.lit("tier-1 project with rto_hours: "),
                                         p.text("operations.rto_hours"), F.lit(" (a week or more)")))
            .register("plausible.storage-class-without-size", "platform.storage_gb",
                      storage_class_without_size, "storage classes are declared but storage_gb is 0")
            .register("plausible.no-prod-environment", "placement.environments", no_prod_environment,
                      lambda p: F.concat(F.lit("no prod environment (found: "),
                                         F.array_join(F.array_sort(F.array_distinct(_environment_names(p))), ", "), F.lit(")")))
            .register("plausible.migrated-with-open-blockers", "migration.blockers", migrated_with_open_blockers,
                      lambda p: F.concat(F.lit("status is 'migrated' but "), F.size(_open_blockers(p)).cast("string"),
                                         F.lit(" blocker(s) are still open: "), F.array_join(_open_blockers(p), ", ")))
            .register("plausible.both-placement-shapes", "placement", both_placement_shapes,
                      "both a single 'datacenter' and an 'environments' list are set")
            .register("plausible.verified-without-review", "_meta.last_reviewed", verified_without_review,
                      "confidence is 'verified' but last_reviewed is empty"))


__all__ = ["Rule", "Rules", "is_known", "shipped_rules"]
