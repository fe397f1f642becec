"""The whole database: load, deduplicate, link, enrich, count and export.

Derived columns live in side tables with one row per `corpusid`, so reloading the papers keeps
them, filling them never moves the wide paper columns, and papers that repeat an id share what
is known of it. Every step writes a new version, repoints its view and appends a record to the
run log. Steps open their tables through that log, so they can be run again after a failure, or
each in a session of its own.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.columns import percent
from paperloom.functions.staging import has_repeated
from paperloom.operators import audit, corpus, dedup, enrich, link, metrics, trends
from paperloom.sources import export, scan, tables


# Tables that stay where their files came, and those that are loaded, with their years' types.
_EXTERNAL = ("s2_abstracts", "s2orc_v2")
_LOADED = ("oa_works", "s2_papers")
_YEARS = {"publication_year": "int", "year": "bigint"}
# Log records of how many papers a derived column covers.
_COVERAGE = "coverage of "


def topic_years(works: DataFrame, papers: DataFrame) -> DataFrame:
    """Linked papers per year and primary topic."""
    lookup = link.papers_lookup(papers, dedup.best_records(works, ["publication_year"]))
    linked = enrich.enrich_topics(
        papers.select("corpusid", "year"), lookup, works, unique_ids=True
    )
    return (
        linked.filter(F.col("oa_primary_topic").isNotNull())
        .groupBy("year", F.col("oa_primary_topic.display_name").alias("topic_name"))
        .agg(F.count(F.lit(1)).alias("num_papers"))
        .orderBy(F.asc_nulls_last("year"), F.desc("num_papers"), "topic_name")
    )


@dataclass(frozen=True)
class Inputs:
    """Paths of the raw Parquet trees."""

    works: str
    sources: Sequence[str]
    papers: str
    abstracts: str
    fulltext: str
    # Source columns whose types differ between vintages.
    drop_from_sources: Sequence[str] = ("is_indexed_in_scopus",)


@dataclass
class Database:
    """Tables below `root`; the run log there tells the current version of each."""

    spark: SparkSession
    root: str
    jobs: list[str] = field(default_factory=list)
    # Whether ids of the works repeat; None until `deduplicate` has looked.
    unique_ids: bool | None = None
    # The versions that steps opened last.
    opened: dict[str, str] = field(default_factory=dict)

    @property
    def log(self) -> str:
        return f"{self.root.rstrip('/')}/run_log"

    def publish(
        self,
        job: str,
        df: DataFrame,
        partition_by: str | None = None,
        year_column: str | None = None,
        seen: Observation | None = None,
        reports: Mapping[str, str] | None = None,
        covered: Mapping[str, Column] | None = None,
        **facts,
    ) -> DataFrame:
        """Write a new version of table `job`, make it current and log it.

        Rows are counted while they are written, nothing is read again unless years are wanted.
        `seen`, which `df` observes, has the number of rows as `total`; `reports` names the jobs
        to be logged with what else it has, each with the prefix of its numbers. `covered` says
        of the derived columns of a side table when they count as filled: for how many of the
        current papers they are is logged as well, for `coverage`.
        """
        started = time.monotonic()
        if covered:
            held = Observation()
            filled = {c: F.when(test, F.col("_papers")).otherwise(0) for c, test in covered.items()}
            df = df.observe(held, *[F.sum(n).alias(c) for c, n in filled.items()]).drop("_papers")
        if seen is None and year_column is None:
            seen = Observation()
            df = df.observe(seen, F.count(F.lit(1)).alias("total"))
        table, path = tables.rebuild_table(df, f"{self.root.rstrip('/')}/{job}", job, partition_by)
        if year_column is None:
            stats = {"total_rows": seen.get["total"]}
        else:
            stats = tables.load_stats(table, year_column).first().asDict()
        elapsed = round(time.monotonic() - started, 1)
        runs = [{"job": job, "path": path, "elapsed_seconds": elapsed, **stats, **facts}]
        for name, prefix in (reports or {}).items():
            numbers = {
                "total_rows": seen.get["total"],
                "rows_updated": seen.get[f"{prefix}updated"],
                "rows_covered": seen.get[f"{prefix}covered"],
            }
            runs.append({"job": name, **numbers, **facts})
        if covered:
            for column in covered:
                kept = {"source": self.opened["s2_papers"], "rows_covered": held.get[column] or 0}
                runs.append({"job": f"{_COVERAGE}{column}", **kept, **facts})
        audit.append_runs(self.spark, self.log, runs)
        self.jobs.extend(run["job"] for run in runs)
        return table

    def previous(self, job: str) -> DataFrame | None:
        """The current version of table `job`, if an earlier run made one."""
        path = audit.latest_path(self.spark, self.log, job)
        if path is None:
            return None
        self.opened[job] = path
        return tables.table_at(self.spark, path)

    def table(self, job: str) -> DataFrame:
        """The current version of table `job`, which an earlier step must have made."""
        if job in _EXTERNAL:
            path = audit.latest_path(self.spark, self.log, job)
            found = None if path is None else scan.scan_parquet(self.spark, path, folder_columns=True)
        else:
            found = self.previous(job)
        if found is None:
            raise ValueError(f"no table {job} below {self.root}: run the step that makes it")
        # Folder names come back as the narrowest type.
        types = {c: t for c, t in _YEARS.items() if c in found.columns and job in _LOADED}
        return found.withColumns({c: F.col(c).cast(t) for c, t in types.items()})

    def _state(self, job: str, columns: Sequence[str]) -> DataFrame:
        """Each paper id once, with the values an earlier run of `job` gave it.

        _papers says how many papers have the id.
        """
        papers = self.table("s2_papers").filter("corpusid IS NOT NULL")
        keys = papers.groupBy("corpusid").agg(F.count(F.lit(1)).alias("_papers"))
        before = self.previous(job)
        if before is None:
            return keys
        return keys.join(before.select("corpusid", *columns), "corpusid", "left")

    # ---- steps ----

    def load(self, inputs: Inputs, test_year: int | None = None) -> None:
        for job, path, year in (
            ("oa_works", inputs.works, "publication_year"),
            ("s2_papers", inputs.papers, "year"),
        ):
            kept = scan.year_filter(
                scan.scan_parquet(self.spark, path, folder_columns=True), year, test_year
            )
            mode = f"year {test_year}" if test_year else "all years"
            self.publish(job, kept, year, year, mode=mode, source=path)
        merged = scan.scan_union_by_name(self.spark, inputs.sources, inputs.drop_from_sources)
        self.publish("oa_sources", merged, mode="all", source=",".join(inputs.sources))
        self.unique_ids, views = None, []
        for job, path in (("s2_abstracts", inputs.abstracts), ("s2orc_v2", inputs.fulltext)):
            scan.view_parquet(self.spark, job, path)
            views.append({"job": job, "mode": "view", "source": path, "path": path})
            self.jobs.append(job)
        audit.append_runs(self.spark, self.log, views)

    def link(self) -> None:
        works, papers = self.table("oa_works"), self.table("s2_papers")
        best = dedup.best_records(works, ["publication_year"])
        pairs = link.papers_lookup(papers, best)
        self.publish("papers_lookup", pairs, year_column="publication_year", mode="full")

    def deduplicate(self) -> DataFrame:
        """View `oa_works_deduped` over the current works."""
        works = self.table("oa_works")
        self.unique_ids = not has_repeated(works, "id")
        deduped = dedup.dedup_works(works, unique_ids=self.unique_ids)
        deduped.createOrReplaceTempView("oa_works_deduped")
        return deduped

    def flag(self, mode: str = "incremental") -> None:
        flags = {"has_abstract": "s2_abstracts", "has_fulltext": "s2orc_v2"}
        state = self._state("paper_flags", list(flags))
        others = {flag: self.table(other) for flag, other in flags.items()}
        for flag in flags:
            if flag not in state.columns:
                state = state.withColumn(flag, F.lit(None).cast("boolean"))
        seen = Observation()
        flagged = enrich.flag_all(state, others, mode=mode, seen=seen)
        reports = {flag: f"{flag}_" for flag in flags}
        covered = {flag: F.col(flag) for flag in flags}
        self.publish("paper_flags", flagged, seen=seen, reports=reports, covered=covered, mode=mode)

    def enrich(self, mode: str = "incremental") -> None:
        state = self._state("paper_topics", ["oa_topics", "oa_concepts", "oa_primary_topic"])
        sides = self.table("papers_lookup"), self.table("oa_works")
        seen = Observation()
        filled = enrich.enrich_topics(state, *sides, mode, unique_ids=bool(self.unique_ids), seen=seen)
        self.publish(
            "paper_topics",
            filled,
            seen=seen,
            reports={"oa_topics": ""},
            covered={"oa_topics": F.col("oa_topics").isNotNull()},
            mode=mode,
        )

    def _with(self, *sides: str) -> DataFrame:
        """Loaded papers with the columns of the given side tables.

        A paper without an id is in no other table: its flags are FALSE.
        """
        whole = self.table("s2_papers")
        for side in sides:
            whole = whole.join(self.table(side), "corpusid", "left")
        flags = [c for c in ("has_abstract", "has_fulltext") if c in whole.columns]
        return whole.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})

    def compose(self) -> None:
        """View `papers`: loaded papers with all their derived columns."""
        self._with("paper_flags", "paper_topics").createOrReplaceTempView("papers")

    def coverage(self) -> DataFrame:
        """`enrich.enrichment_coverage` of the view `papers`.

        Side tables are counted while they are written, so this reads the run log alone. Only
        where papers were loaded since then, their side table is joined and counted again.
        """
        log = audit.run_log(self.spark, self.log)
        papers = log.filter("job = 's2_papers'").orderBy(F.desc("run_id")).first()
        if papers is None:
            raise ValueError(f"no table s2_papers below {self.root}: run the step that makes it")
        kept = log.filter(F.col("job").startswith(_COVERAGE) & (F.col("source") == papers["path"]))
        column = F.substring("job", len(_COVERAGE) + 1, 100)
        latest = kept.groupBy(column.alias("column")).agg(
            F.lit(papers["total_rows"]).alias("total"),
            F.max_by("rows_covered", "run_id").alias("covered"),
        )
        pct = percent(F.col("covered"), F.col("total"), 1)
        found = latest.select("column", "total", "covered", pct.alias("pct"))
        known = {row["column"] for row in latest.collect()}
        for side, first in (("paper_flags", "has_abstract"), ("paper_topics", "oa_topics")):
            if first not in known and self.previous(side) is not None:
                found = found.unionByName(enrich.enrichment_coverage(self._with(side)))
        return found

    def count(self) -> None:
        papers = self._with("paper_flags")
        for group in metrics.GROUPS:
            rows = metrics.compute_metrics(papers, group, ordered=False)
            table = self.publish(f"{group}_metrics", rows, year_column="year", mode="full")
            export.export_metrics(table, path=f"{self.root.rstrip('/')}/export/{group}_metrics")
        counts = trends.topic_counts(self.table("oa_works"))
        counts = self.publish("topic_counts", counts, year_column="publication_year", mode="full")
        self.publish("topic_missing", trends.missing_topic_share(counts), mode="full")
        for column in ("subfield_name", "topic_name"):
            shares = trends.trend_share(trends.trend(counts, column))
            self.publish(column.replace("_name", "_trend"), shares, mode="full")
        self.publish("topic_heatmap", trends.heatmap(counts), mode="full")

    def collect_fulltext(self, year_lt: int | None = 1991) -> None:
        texts = corpus.fulltext_corpus(
            self._with("paper_flags"), self.table("s2orc_v2"), year_lt=year_lt
        )
        self.publish("arxiv_fulltext", texts, year_column="year", mode=f"year < {year_lt}")

    def build(self, inputs: Inputs, test_year: int | None = None, mode: str = "incremental") -> None:
        """All steps in order."""
        self.load(inputs, test_year)
        self.deduplicate()
        self.link()
        self.flag(mode)
        self.enrich(mode)
        self.compose()
        self.count()
        self.collect_fulltext()
