"""Stored relations: upserts, updates, deletes, and the review workflow over them.

A table is a directory of Parquet versions. A commit is a small file, numbered
and never changed, that names the version of every table. A step of a workflow
writes the new versions of all tables it changes and then one commit, by a
rename: readers see all of a step or nothing, and a failed one leaves the last
commit in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions.text import joined_fingerprint, short_hash
from paperloom.operators.dedup import asset_groups, representatives
from paperloom.schemas import TABLES, UPDATED
from paperloom.scratch import stored


def latest(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key by ``order``."""
    last = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")


def upsert(known_rows: DataFrame, fresh: DataFrame, keys: tuple[str, ...], updated: tuple[str, ...]) -> DataFrame:
    """``known_rows`` with ``fresh`` merged in by key: new keys are added, and known ones take the ``updated`` columns.

    ``fresh`` has one row for each key (see ``latest``). One full join on the keys.
    """
    s, f = known_rows.alias("s"), fresh.alias("f")
    met = s.join(f, [F.col(f"s.{k}") == F.col(f"f.{k}") for k in keys], "full")
    known, given = F.col(f"s.{keys[0]}").isNotNull(), F.col(f"f.{keys[0]}").isNotNull()

    def pick(c: str) -> Column:
        if c not in fresh.columns:
            return F.col(f"s.{c}")
        if c in keys:
            return F.coalesce(F.col(f"s.{c}"), F.col(f"f.{c}"))
        return F.when(given & (~known | F.lit(c in updated)), F.col(f"f.{c}")).otherwise(F.col(f"s.{c}"))

    return met.select(*[pick(c).alias(c) for c in known_rows.columns])


def insert_new(known_rows: DataFrame, fresh: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``known_rows`` and those rows of ``fresh`` whose key they lack."""
    more = fresh.join(known_rows.select(*keys), list(keys), "left_anti")
    return known_rows.unionByName(more, allowMissingColumns=True)


def delete(known_rows: DataFrame, keys: DataFrame, on: tuple[str, ...]) -> DataFrame:
    return known_rows.join(keys, list(on), "left_anti")


def update(known_rows: DataFrame, changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Known rows take all columns of ``changes``; unknown keys are ignored."""
    columns = tuple(c for c in changes.columns if c not in keys)
    known = changes.join(known_rows.select(*keys), list(keys), "left_semi")
    return upsert(known_rows, known, keys, columns)


class Store:
    """The engine's tables under one path that all executors share.

    One writer at a time: a commit whose number has been taken meanwhile is an error.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._pending: dict[str, str] | None = None

    def _fs(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _commits(self) -> list[str]:
        fs, at = self._fs(f"{self.path}/_commits")
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def _state(self) -> tuple[int, dict[str, str]]:
        """The last commit's number, and the version of each table; those of an open step come first."""
        names = self._commits()
        known = json.loads(self.spark.read.text(f"{self.path}/_commits/{names[-1]}").first()[0]) if names else {}
        return (int(names[-1]) if names else 0), known | (self._pending or {})

    def _commit(self, versions: dict[str, str]) -> None:
        number, known = self._state()
        fresh = f"{self.path}/_new-{uuid.uuid4().hex}"
        self.spark.createDataFrame([(json.dumps(known | versions),)], "value string").coalesce(1).write.text(fresh)
        fs, log = self._fs(f"{self.path}/_commits")
        fs.mkdirs(log)
        _, target = self._fs(f"{self.path}/_commits/{number + 1:020d}")
        if fs.exists(target) or not fs.rename(self._fs(fresh)[1], target):
            raise RuntimeError(f"commit {number + 1} was not written; the tables are as they were")

    @contextmanager
    def step(self) -> Iterator[None]:
        """All changes inside become visible to others with one commit at the end, or not at all."""
        if self._pending is not None:
            yield
            return
        self._pending = {}
        try:
            yield
            done, self._pending = self._pending, None
            if done:
                self._commit(done)
        finally:
            self._pending = None

    def init(self) -> list[str]:
        """Create the tables that are missing; returns their names.

        A folder that holds versions of a table but no commit that names one is
        not taken for a missing table: its log has been lost.
        """
        missing = self.missing()
        for name in missing:
            fs, at = self._fs(f"{self.path}/{name}")
            if not self._commits() and fs.exists(at) and fs.listStatus(at):
                raise ValueError(f"{self.path}/{name} has versions, but no commit names one")
        with self.step():
            for name in missing:
                self.replace(name, self.spark.createDataFrame([], TABLES[name][0]))
        return missing

    def missing(self) -> list[str]:
        known = self._state()[1]
        return sorted(n for n in TABLES if n not in known)

    def read(self, name: str) -> DataFrame:
        version = self._state()[1].get(name)
        if version is None:
            raise ValueError(f"table {name} has not been created")
        return self.spark.read.schema(TABLES[name][0]).parquet(f"{self.path}/{name}/{version}")

    def replace(self, name: str, rows: DataFrame) -> None:
        version = f"v-{uuid.uuid4().hex}"
        schema = self.spark.createDataFrame([], TABLES[name][0]).schema
        kept = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        kept.write.parquet(f"{self.path}/{name}/{version}")
        with self.step():
            self._pending[name] = version

    def upsert(self, name: str, rows: DataFrame) -> None:
        keys = TABLES[name][1]
        self.replace(name, upsert(self.read(name), _stamped(rows, name), keys, UPDATED[name]))

    def insert_new(self, name: str, rows: DataFrame) -> None:
        self.replace(name, insert_new(self.read(name), _stamped(rows, name), TABLES[name][1]))

    def update(self, name: str, changes: DataFrame) -> None:
        self.replace(name, update(self.read(name), changes, TABLES[name][1]))

    def save_result(self, papers: DataFrame, questions: DataFrame, assets: DataFrame | None = None) -> None:
        """Save what ingestion made of papers: papers, blocks, questions, choices and quality reports, in one step.

        ``papers(id, ...)``; ``questions`` as ``plans.ingest`` makes them, one row
        for each block; questions whose gate failed are not saved, their blocks are.
        """
        block_id = F.format_string("%s_qb_%04d", F.col("paper_id").cast("string"), F.col("block_index").cast("int"))
        rows = stored(questions.withColumn("question_block_id", block_id), "ingested")
        good = rows.where("gate <> 'failed'").withColumn("id", F.col("question_id"))
        option = F.posexplode("choices").alias("n", "c")
        choices = good.select("question_id", option).select(
            F.concat_ws("_", "question_id", F.col("c.label")).alias("id"), "question_id", F.col("c.label").alias("label"), F.col("c.content_latex").alias("content_latex"), (F.col("n") + 1).alias("sort_order"),
        )
        with self.step():
            self.upsert("papers", papers)
            self.upsert("question_blocks", rows.withColumn("id", F.col("question_block_id")).withColumn("paper_id", F.col("paper_id").cast("string")))
            self.upsert("questions", good.withColumns({"quality_status": F.col("gate"), "review_status": F.when(F.col("needs_review"), "needs_review").otherwise("auto_passed")}))
            self.upsert("choices", latest(choices, ("question_id", "label"), "sort_order"))
            reports = good.withColumns({"id": F.concat("question_id", F.lit("_qr")), "rule_errors": F.col("issues")})
            self.upsert("quality_reports", reports)
            if assets is not None:
                self.upsert("raw_assets", assets)

    def generate_canonical_assets(self, min_candidates: int = 2) -> DataFrame:
        """Canonical assets, and their variants, of all raw assets with equal content in several papers; returns the former."""
        made = canonical_asset_rows(self.read("raw_assets"), min_candidates)
        with self.step():
            self.upsert("canonical_assets", made["canonical"])
            self.upsert("asset_variants", made["variants"])
        return self.read("canonical_assets").join(made["canonical"].select("id"), "id", "left_semi")

    # The review workflow.

    def save_groups(self, groups: DataFrame) -> None:
        """Save candidate groups (with ``items``); their former items go, and their status is pending again."""
        item = groups.select(F.col("id").alias("group_id"), F.explode("items").alias("i")).select("group_id", "i.*")
        item = item.withColumn("id", F.concat_ws("_", "group_id", "block_id"))
        rest = delete(self.read("duplicate_candidate_items"), groups.select(F.col("id").alias("group_id")), ("group_id",))
        with self.step():
            self.upsert("duplicate_candidate_groups", groups.drop("items"))
            self.replace("duplicate_candidate_items", rest.unionByName(item, allowMissingColumns=True))

    def decide(self, decisions: DataFrame) -> None:
        """Record ``(group_id, decision, reviewer, reason)``; a repeated decision of a reviewer changes nothing."""
        allowed = F.assert_true(F.col("decision").isin("same", "different", "unsure", "skip"), F.lit("unknown decision")).isNull()
        keyed = decisions.withColumn("id", F.concat_ws("_", F.lit("drd"), "group_id", "reviewer", "decision")).where(allowed)
        self.insert_new("duplicate_review_decisions", keyed.dropDuplicates(["id"]))

    def canonicalize(self, created_by: str) -> DataFrame:
        """Canonical questions for all groups that a reviewer called the same.

        Groups without one get it, with variants and an event, and are resolved;
        reverted ones are made active again, with an event; active ones stay.
        Returns the canonical questions of those groups.
        """
        groups, items = self.read("duplicate_candidate_groups"), self.read("duplicate_candidate_items")
        same = self.read("duplicate_review_decisions").where("decision = 'same'").select(F.col("group_id").alias("id")).distinct()
        open_ = groups.join(same, "id", "left_semi").select(F.col("id").alias("group_id"))
        made = canonical_rows(items.join(open_, "group_id", "left_semi"), created_by)
        canon = self.read("canonical_questions")
        old = canon.where("status = 'reverted'").join(open_.withColumnRenamed("group_id", "created_from_group_id"), "created_from_group_id", "left_semi")
        back = stored(old.select("id", F.lit("active").alias("status")), "reactivated")
        events = back.select(F.concat("id", F.lit("_reactivated_"), _stamp()).alias("id"), F.col("id").alias("canonical_question_id"), F.lit("reactivated").alias("event_type"), F.lit(created_by).alias("created_by"))
        with self.step():
            self.insert_new("canonicalization_events", events.unionByName(made["events"], allowMissingColumns=True))
            self.insert_new("question_variants", made["variants"])
            variants = self.read("question_variants").join(back.select(F.col("id").alias("canonical_question_id")), "canonical_question_id", "left_semi")
            self.update("question_variants", variants.select("id", F.lit(True).alias("is_active")))
            self.update("canonical_questions", back)
            self.insert_new("canonical_questions", made["canonical"])
            self.update("duplicate_candidate_groups", open_.select(F.col("group_id").alias("id"), F.lit("resolved").alias("status")))
        return self.read("canonical_questions").join(open_.withColumnRenamed("group_id", "created_from_group_id"), "created_from_group_id", "left_semi")

    def rollback(self, canonical: DataFrame, created_by: str) -> None:
        """Revert canonical questions ``(id)`` and deactivate their variants, with an event for each; unknown ids are ignored."""
        ids = stored(self.read("canonical_questions").join(canonical.select("id"), "id", "left_semi").select("id"), "reverted")
        events = ids.select(F.concat("id", F.lit("_reverted_"), _stamp()).alias("id"), F.col("id").alias("canonical_question_id"), F.lit("").alias("group_id"), F.lit("reverted").alias("event_type"), F.lit(created_by).alias("created_by"))
        with self.step():
            self.update("canonical_questions", ids.withColumn("status", F.lit("reverted")))
            variants = self.read("question_variants").join(ids.withColumnRenamed("id", "canonical_question_id"), "canonical_question_id", "left_semi")
            self.update("question_variants", variants.select("id", F.lit(False).alias("is_active")))
            self.insert_new("canonicalization_events", events)

    # Lookups.

    def review_queue(self, limit: int = 50) -> DataFrame:
        reports = self.read("quality_reports").where("needs_review")
        return review_queue(reports, self.read("questions"), limit)

    def duplicate_groups(self, status: str | None = None, limit: int = 50) -> DataFrame:
        return newest(self.read("duplicate_candidate_groups"), status, limit, F.desc("candidate_count"))

    def duplicate_group(self, group_id: str) -> DataFrame:
        """A group with its items, by paper and number, and its decisions, newest first."""
        group = self.read("duplicate_candidate_groups").where(F.col("id") == group_id)
        items = self.read("duplicate_candidate_items").where(F.col("group_id") == group_id)
        decisions = self.read("duplicate_review_decisions").where(F.col("group_id") == group_id)
        return nested(nested(group, items, "group_id", "items", ("paper_id", "question_number", "id")), decisions, "group_id", "decisions", ("created_at", "id"), newest_first=True)

    def canonical_questions(self, status: str | None = None, limit: int = 50) -> DataFrame:
        return newest(self.read("canonical_questions"), status, limit)

    def canonical_question(self, canonical_id: str) -> DataFrame:
        found = self.read("canonical_questions").where(F.col("id") == canonical_id)
        variants = self.read("question_variants").where(F.col("canonical_question_id") == canonical_id)
        return nested(found, variants, "canonical_question_id", "variants", ("paper_id", "id"))

    def raw_assets(self, paper_id: str | None = None, limit: int = 100) -> DataFrame:
        rows = self.read("raw_assets")
        if paper_id is not None:
            return rows.where(F.col("paper_id") == paper_id).orderBy("page", "id").limit(limit)
        return newest(rows, None, limit)


    def canonical_of_group(self, group_id: str) -> DataFrame:
        return self.read("canonical_questions").where(F.col("created_from_group_id") == group_id)

    def assets_with_content(self, content_hash: str) -> DataFrame:
        return self.read("raw_assets").where(F.col("content_hash") == content_hash).orderBy("paper_id", "id")

    def canonical_assets(self, limit: int = 50) -> DataFrame:
        return newest(self.read("canonical_assets"), None, limit)

    def canonical_asset(self, canonical_id: str) -> DataFrame:
        found = self.read("canonical_assets").where(F.col("id") == canonical_id)
        variants = self.read("asset_variants").where(F.col("canonical_asset_id") == canonical_id)
        return nested(found, variants, "canonical_asset_id", "variants", ("raw_asset_id",))

    def asset_candidates(self, min_candidates: int = 2) -> dict[str, DataFrame]:
        """Canonical assets that ``generate_canonical_assets`` would save, and their variants; over all raw assets."""
        return canonical_asset_rows(self.read("raw_assets"), min_candidates)


def _stamp() -> Column:
    return F.date_format(F.current_timestamp(), "yyyyMMddHHmmssSSSSSS")


def _stamped(rows: DataFrame, name: str) -> DataFrame:
    """Rows with creation and update times where the table has them and the rows don't."""
    times = {c: F.current_timestamp() for c in ("created_at", "updated_at") if f"{c} timestamp" in TABLES[name][0] and c not in rows.columns}
    return rows.withColumns(times)


def newest(rows: DataFrame, status: str | None, limit: int, *first: Column) -> DataFrame:
    kept = rows if status is None else rows.where(F.col("status") == status)
    return kept.orderBy(*first, F.desc("created_at"), "id").limit(limit)


def review_queue(reports: DataFrame, questions: DataFrame, limit: int = 50) -> DataFrame:
    """Reports with their questions, the lowest score first, then the oldest; issues as lists of codes."""
    q = questions.select(F.col("id").alias("question_id"), "question_type", "stem_latex")
    codes = lambda c: F.transform(F.coalesce(F.col(c), F.array()), lambda e: e["code"])
    joined = reports.join(q, "question_id").withColumn("rule_codes", codes("rule_errors"))
    return joined.orderBy("overall_score", "created_at", "question_id").limit(limit).select("question_id", "question_type", "stem_latex", "overall_score", "rule_codes", "model_warnings")


def nested(rows: DataFrame, parts: DataFrame, key: str, name: str, order: tuple[str, ...], newest_first: bool = False) -> DataFrame:
    """``rows`` with their parts as an ordered list of structs."""
    ranked = F.struct(*order, F.struct(*parts.columns).alias("row"))
    listed = F.transform(F.sort_array(F.collect_list(ranked), not newest_first), lambda x: x["row"])
    gathered = parts.groupBy(F.col(key).alias("id")).agg(listed.alias(name))
    return rows.join(gathered, "id", "left").withColumn(name, F.coalesce(name, F.array()))


def canonical_rows(items: DataFrame, created_by: str) -> dict[str, DataFrame]:
    """Canonical questions, variants and events for groups of items (``group_id`` and item columns)."""
    cid = F.concat(F.lit("cqn_"), short_hash(F.col("group_id")))
    best = representatives(items).select("group_id", F.col("block_id").alias("representative_item_id"))
    summed = items.groupBy("group_id").agg(F.collect_set("text_fingerprint").alias("fps"), F.count("*").alias("n"), F.array_sort(F.collect_list("block_id")).alias("blocks"))
    joined = summed.join(best, "group_id").withColumn("id", cid)
    none = F.lit("")
    canonical = joined.select(
        "id", joined_fingerprint(F.col("fps")).alias("canonical_fingerprint"), "representative_item_id", none.alias("stem_latex"), none.alias("answer_latex"), none.alias("analysis_latex"),
        none.alias("question_type"), F.lit("active").alias("status"), F.col("group_id").alias("created_from_group_id"), F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"),
    )
    variants = items.withColumn("canonical_question_id", cid).select(
        F.concat("canonical_question_id", F.lit("_var_"), "block_id").alias("id"), "canonical_question_id", "question_id", "paper_id", F.lit("candidate").alias("variant_type"),
        "source_position_key", "text_fingerprint", "latex_fingerprint", "asset_signature", F.lit(True).alias("is_active"),
    )
    names = F.transform("blocks", lambda b: F.concat(F.col("id"), F.lit("_var_"), b))
    payload = F.to_json(F.struct(F.col("n").alias("item_count"), "representative_item_id", names.alias("variant_ids")))
    events = joined.select(F.concat("id", F.lit("_evt_created")).alias("id"), F.col("id").alias("canonical_question_id"), "group_id", F.lit("created").alias("event_type"), payload.alias("payload"), F.lit(created_by).alias("created_by"), F.current_timestamp().alias("created_at"))
    return {"canonical": canonical, "variants": variants, "events": events}


def canonical_asset_id(content_hash: Column) -> Column:
    return F.concat(F.lit("ca_"), short_hash(content_hash))


def canonical_asset_rows(assets: DataFrame, min_candidates: int = 2) -> dict[str, DataFrame]:
    """Canonical assets and variants of raw assets with equal content in several papers, of one type.

    The representative is the least id. Its fingerprint hashes the distinct
    contents, of which a group has one.
    """
    groups = asset_groups(assets, min_candidates).select("content_hash", F.col("representative").alias("representative_raw_asset_id"))
    fields = [F.coalesce(c, F.lit("")).alias(c) if c == "perceptual_hash" else F.col(c) for c in ("storage_url", "perceptual_hash", "asset_type") if c in assets.columns]
    of = assets.select(F.col("id").alias("representative_raw_asset_id"), *fields)
    canonical = groups.join(of, "representative_raw_asset_id").withColumns({"id": canonical_asset_id(F.col("content_hash")), "asset_fingerprint": short_hash(F.col("content_hash")), "status": F.lit("active")})
    variants = assets.select(F.col("id").alias("raw_asset_id"), "content_hash").join(groups.select("content_hash"), "content_hash")
    variants = variants.withColumn("canonical_asset_id", canonical_asset_id(F.col("content_hash"))).select(
        F.concat_ws("_var_", "canonical_asset_id", F.col("raw_asset_id").cast("string")).alias("id"), "canonical_asset_id", "raw_asset_id", F.lit("{}").alias("transform"), F.lit(None).cast("double").alias("similarity"), F.lit(True).alias("is_active"),
    )
    return {"canonical": canonical, "variants": variants}
