"""Duplicate candidates across papers, their similarities, representatives, and visual groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.bits import halves
from paperloom.functions.text import short_hash
from paperloom.operators.graph import components
from paperloom.scratch import stored

#: Weights of equal texts, formulas and assets, and of shared sections.
WEIGHTS = {"text_fingerprint": 0.25, "latex_fingerprint": 0.35, "asset_signature": 0.25}
SECTION_WEIGHT = 0.15
FINGERPRINTS = {"text": "text_fingerprint", "latex": "latex_fingerprint", "asset": "asset_signature"}
#: Rows of a block, about; a tile compares two blocks.
TILE = 4096
#: Bits of a row's number below its distance in one long.
ID_BITS = 50


def section_jaccard(a: Column, b: Column) -> Column:
    """Shared parts over all parts of two paths; 0 if neither has any."""
    parts = lambda p: F.filter(F.split(p, "/"), lambda x: F.length(x) > 0)
    every = F.size(F.array_union(parts(a), parts(b)))
    return F.when(every == 0, 0.0).otherwise(F.size(F.array_intersect(parts(a), parts(b))) / every)


def candidate_items(identities: DataFrame, kind: str = "text", min_candidates: int = 2) -> DataFrame:
    """Identities that share a fingerprint with those of ``min_candidates`` papers in all, with ``fingerprint``,
    ``idx`` (place in the group) and ``n_items``.

    Papers are counted by a grouped aggregate and joined back, so that a group
    of any size is never one task's. The join is an equality that skew handling
    splits. Identities are written first: both sides read them, and hashing texts once is enough.
    """
    rows = stored(identities, "identities").withColumn("fingerprint", F.col(FINGERPRINTS[kind])).where(F.length("fingerprint") > 0)
    shared = rows.groupBy("fingerprint", "paper_id").agg(F.count("*").alias("n")).groupBy("fingerprint").agg(F.count("*").alias("papers"), F.sum("n").alias("n_items"))
    return rows.join(shared.where(F.col("papers") >= min_candidates), "fingerprint")


def _path(row: str = "") -> Column:
    """The section path inside a position key."""
    key, paper = F.col(f"{row}source_position_key"), F.col(f"{row}paper_id")
    body = F.regexp_replace(key, "#[^#]*$", "")
    return F.when(F.startswith(body, F.concat(paper, F.lit("#"))), F.substr(body, F.length(paper) + 2)).otherwise("")


def with_paths(items: DataFrame) -> DataFrame:
    return items.withColumns({"section_path": _path(), "question_number": F.substring_index("source_position_key", "#", -1)})


def pair_score(a: str = "a.", b: str = "b.") -> Column:
    """Similarity of two items."""
    same = lambda c: ((F.col(a + c) == F.col(b + c)) & (F.length(a + c) > 0)).cast("double")
    return sum((w * same(c) for c, w in WEIGHTS.items()), F.lit(0.0)) + SECTION_WEIGHT * section_jaccard(F.col(a + "section_path"), F.col(b + "section_path"))


def average_scores(items: DataFrame, group: str = "fingerprint") -> DataFrame:
    """``items`` with ``avg_score``, the mean similarity to the others of the group.

    Nothing is paired: equal fields are counted. An item's sum over its group
    is the number of items with its value, for each field, and for sections the
    Jaccard with each distinct path times that path's count.
    """
    n = items.groupBy(group).agg(F.count("*").alias("_n"))
    out = items.join(n, group)
    total = F.lit(0.0)
    for c, w in WEIGHTS.items():
        counts = items.groupBy(group, c).agg(F.count("*").alias(f"_{c}"))
        out = out.join(counts, [group, c])
        total = total + w * F.when(F.length(c) > 0, F.col(f"_{c}") - 1).otherwise(0)
    paths = items.groupBy(group, "section_path").agg(F.count("*").alias("_p"))
    l, r = paths.select(group, F.col("section_path").alias("a")), paths.select(group, F.col("section_path").alias("b"), F.col("_p").alias("k"))
    summed = l.join(r, group).groupBy(group, F.col("a").alias("section_path")).agg(F.sum(section_jaccard(F.col("a"), F.col("b")) * F.col("k")).alias("_j"))
    self_share = section_jaccard(F.col("section_path"), F.col("section_path"))
    out = out.join(summed, [group, "section_path"])
    total = total + SECTION_WEIGHT * (F.col("_j") - self_share)
    return out.withColumn("avg_score", F.when(F.col("_n") > 1, F.round(total / (F.col("_n") - 1), 12)).otherwise(0.0)).drop("_n", "_j", *[f"_{c}" for c in WEIGHTS])


def trimmed(items: DataFrame, most: int = 20, group: str = "fingerprint", order: str = "block_id") -> DataFrame:
    """Groups cut to the ``most`` items with the highest mean similarity, ties in the items' order."""
    best = Window.partitionBy(group).orderBy(F.desc("avg_score"), order)
    return average_scores(items, group).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).drop("rank")


def pairs(items: DataFrame, group: str = "fingerprint", order: str = "block_id") -> DataFrame:
    """``(group, i, j, score)`` of all pairs of trimmed groups, whose size is bounded."""
    place = items.withColumn("idx", F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1)
    a, b = place.alias("a"), place.alias("b")
    met = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col("a.idx") < F.col("b.idx")))
    return met.select(F.col(f"a.{group}").alias(group), F.col("a.idx").alias("i"), F.col("b.idx").alias("j"), pair_score().alias("score"))


def candidate_groups(identities: DataFrame, kind: str = "text", min_candidates: int = 2, most: int = 20) -> DataFrame:
    """``(id, fingerprint, fingerprint_type, candidate_count, max_similarity, status, items)``, largest first by count.

    Groups need ``min_candidates`` papers; their items are those that ``trimmed`` keeps.
    """
    items = stored(with_paths(candidate_items(identities, kind, min_candidates)), "candidate-items")
    kept = stored(trimmed(items, most), "candidate-kept")
    best = pairs(kept).groupBy("fingerprint").agg(F.max("score").alias("max_similarity"))
    item = F.struct("block_id", "paper_id", "section_path", "question_number", "source_position_key", "text_fingerprint", "latex_fingerprint", "asset_signature")
    found = kept.groupBy("fingerprint").agg(F.count("*").cast("int").alias("candidate_count"), F.array_sort(F.collect_list(item)).alias("items"))
    found = found.join(best, "fingerprint", "left")
    return found.select(F.concat(F.lit("dcg_"), short_hash(F.col("fingerprint"))).alias("id"), "fingerprint", F.lit(kind).alias("fingerprint_type"), "candidate_count", F.coalesce("max_similarity", F.lit(0.0)).alias("max_similarity"), F.lit("pending").alias("status"), "items")


def representatives(items: DataFrame, group: str = "group_id") -> DataFrame:
    """The item of each group with the highest mean similarity; ties go to the smaller position key, then block."""
    best = Window.partitionBy(group).orderBy(F.desc("avg_score"), "source_position_key", "block_id")
    return average_scores(items, group).withColumn("r", F.row_number().over(best)).where("r = 1").drop("r")


def asset_groups(assets: DataFrame, min_candidates: int = 2) -> DataFrame:
    """``(content_hash, asset_type, representative, size, papers)`` of assets of one type with equal content in several papers."""
    found = assets.where(F.length("content_hash") > 0).groupBy("content_hash").agg(
        F.count_distinct("paper_id").alias("papers"), F.count("*").alias("size"), F.min("asset_type").alias("asset_type"), F.max("asset_type").alias("_t"), F.min("id").alias("representative")
    )
    return found.where((F.col("papers") >= min_candidates) & (F.col("asset_type") == F.col("_t"))).drop("_t")


def _hashed(assets: DataFrame, digits: int) -> DataFrame:
    """``(id, paper_id, asset_type, w, digits)`` of assets that may be linked; ``w`` is the hash in longs of 64 bits."""
    parts = halves(F.col("perceptual_hash"), -(-digits // 8))
    words = [F.shiftleft(h, 32).bitwiseOR(parts[i + 1]) if i + 1 < len(parts) else h for i, h in enumerate(parts) if i % 2 == 0]
    rows = assets.where((F.length("perceptual_hash") > 0) & (F.length("paper_id") > 0) & F.col("asset_type").isNotNull())
    return rows.select("id", "paper_id", "asset_type", F.array(*words).alias("w"), F.length("perceptual_hash").alias("digits")).where(~F.exists("w", lambda x: x.isNull()))


def _near(rows: DataFrame, key: str, keep: list[str], max_distance: int, digits: int, differ: tuple[str, ...] = ()) -> DataFrame:
    """``(asset_type, a, b, distance)``: every pair of rows of one type within the distance once, ``a`` and ``b`` being
    structs of ``keep`` whose fields in ``differ`` differ; ``key`` tells rows apart.

    A type's rows are dealt to blocks of about TILE; two blocks meet in a tile,
    one of many keys of an equality join, in which a pair costs a bit count.
    """
    size = F.ceil(F.count("*") / TILE)
    same = F.min("digits") == F.max("digits")
    blocks = rows.groupBy("asset_type").agg(F.when(same, size).otherwise(F.raise_error(F.lit("hashes differ in length")).cast("long")).alias("blocks"))
    dealt = rows.hint("merge").join(blocks, "asset_type").withColumn("at", F.pmod(F.xxhash64(key), F.col("blocks")))
    n = -(-digits // 16)
    side = lambda x: [F.struct(*keep).alias(x), *[F.get("w", i).alias(f"{x}{i}") for i in range(n)]]
    a = dealt.select("asset_type", F.col("at").alias("lo"), F.explode(F.sequence("at", F.col("blocks") - 1)).alias("hi"), *side("a"))
    b = dealt.select("asset_type", F.explode(F.sequence(F.lit(0).cast("long"), "at")).alias("lo"), F.col("at").alias("hi"), *side("b"))
    a, b = a.alias("l"), b.alias("r")
    far = F.lit(0)
    for i in range(n):
        far = far + F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")))
    meet = (F.col("l.asset_type") == F.col("r.asset_type")) & (F.col("l.lo") == F.col("r.lo")) & (F.col("l.hi") == F.col("r.hi")) & (far <= max_distance)
    meet &= (F.col("l.lo") < F.col("l.hi")) | (F.col(f"a.{key}") < F.col(f"b.{key}"))
    for c in differ:
        meet &= F.col(f"a.{c}") != F.col(f"b.{c}")
    return a.hint("merge").join(b, meet).select(F.col("l.asset_type").alias("asset_type"), "a", "b", far.alias("distance"))


def hamming_edges(assets: DataFrame, max_distance: int = 8, digits: int = 16) -> DataFrame:
    """``(asset_type, a, b, paper_a, paper_b, distance)``: assets of one type in different papers whose hashes
    differ in at most ``max_distance`` bits.

    All hashes of a type are compared, at every distance alike: where the
    distance is a third of the bits, a fixed share of all pairs is linked.
    Hashes are written first, as both sides read them.
    """
    met = _near(stored(_hashed(assets, digits), "hashed-assets"), "id", ["id", "paper_id"], max_distance, digits, ("paper_id",))
    first = F.col("a.id") < F.col("b.id")
    pick = lambda x, y, c: F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}"))
    return met.select("asset_type", pick("a", "b", "id").alias("a"), pick("b", "a", "id").alias("b"), pick("a", "b", "paper_id").alias("paper_a"), pick("b", "a", "paper_id").alias("paper_b"), "distance")


def _two_best(rows: DataFrame, group: list[str], key: str, paper: str) -> DataFrame:
    """``(group, k1, p1, k2, p2)``: the least ``key`` of each group and the least one of another paper."""
    firsts = rows.groupBy(*group, paper).agg(F.min(key).alias(key))
    firsts = firsts.withColumn("r", F.row_number().over(Window.partitionBy(*group).orderBy(key))).where("r <= 2")
    of = lambda c, r: F.min(F.when(F.col("r") == r, F.col(c)))
    return firsts.groupBy(*group).agg(of(key, 1).alias("k1"), of(paper, 1).alias("p1"), of(key, 2).alias("k2"), of(paper, 2).alias("p2"))


def _first_edges(rows: DataFrame, max_distance: int, digits: int) -> DataFrame:
    """``(a, b, distance)``: the edge of each row ``(n, p, asset_type, w)`` that comes first by distance, then by ids.

    Of neighbours at one distance that with the least number gives the first edge. Rows of one hash have the same
    neighbours but for their own paper's: two candidates of different papers serve them all.
    """
    classes = _two_best(rows, ["asset_type", "w", "digits"], "n", "p").withColumn("c", F.col("k1"))
    classes = stored(classes, "visual-classes")
    met = _near(classes, "c", ["c", "k1", "p1", "k2", "p2"], max_distance, digits)
    item = lambda c, d, x, i: F.struct(F.col(c).alias("c"), F.shiftleft(d.cast("long"), ID_BITS).bitwiseOR(F.col(f"{x}k{i}")).alias("key"), F.col(f"{x}p{i}").alias("p"))
    d, none = F.col("distance"), F.lit(0)
    found = met.select(F.inline(F.array(*[item(c, d, x, i) for c, x in (("a.c", "b."), ("b.c", "a.")) for i in (1, 2)])))
    found = found.unionByName(classes.select(F.inline(F.array(*[item("c", none, "", i) for i in (1, 2)])))).where("key is not null")
    best = _two_best(found, ["c"], "key", "p")
    mine = rows.select("n", "p", "asset_type", "w").hint("merge").join(classes.select("asset_type", "w", "c"), ["asset_type", "w"]).hint("merge").join(best, "c")
    key = F.when(F.col("p") != F.col("p1"), F.col("k1")).otherwise(F.col("k2"))
    other = key.bitwiseAND((1 << ID_BITS) - 1)
    edges = mine.select("n", other.alias("o"), F.shiftright(key, ID_BITS).cast("int").alias("distance")).where("o is not null")
    return edges.select(F.least("n", "o").alias("a"), F.greatest("n", "o").alias("b"), "distance").distinct()


def visual_groups(assets: DataFrame, max_distance: int = 8, min_candidates: int = 2, digits: int = 16) -> DataFrame:
    """``(group_id, asset_type, members, size, avg_distance, min_distance, max_distance)``: greedy clusters.

    Edges are taken by distance, then by ids; an edge joins a free asset to the
    other's cluster or starts one, and is passed over if both have one. An asset
    is free until its first edge, which is therefore taken, and an edge that is
    neither end's first is passed over: clusters are the components of the
    assets' first edges, and no edge waits for another. Ids tell a type's assets apart.
    """
    rows = _hashed(assets, digits).orderBy("id", "asset_type").withColumn("n", F.monotonically_increasing_id())
    rows = stored(rows, "visual-rows")
    papers = rows.groupBy("paper_id").agg(F.min("n").alias("p"))
    edges = stored(_first_edges(rows.hint("merge").join(papers, "paper_id"), max_distance, digits), "visual-edges")
    label = stored(components(edges.select("a", "b")), "visual-labels")
    label = label.unionByName(label.select(F.col("label").alias("node"), "label").distinct())
    far = edges.join(label, F.col("a") == F.col("node")).groupBy("label").agg(F.avg("distance").alias("avg_distance"), F.min("distance").alias("min_distance"), F.max("distance").alias("max_distance"))
    found = rows.join(label, F.col("n") == F.col("node")).groupBy("label").agg(F.min("asset_type").alias("asset_type"), F.array_sort(F.collect_list("id")).alias("members"), F.count_distinct("paper_id").alias("papers"))
    name = F.concat(F.lit("vag_"), short_hash(F.array_join("members", "|")))
    found = found.where(F.col("papers") >= min_candidates).join(far, "label")
    return found.select(name.alias("group_id"), "asset_type", "members", F.size("members").alias("size"), "avg_distance", "min_distance", "max_distance")
