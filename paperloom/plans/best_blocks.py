"""The blocks of a paper that suit an asset best, or that a text meets first, without pairing all with all.

Blocks are in reading order, so that neighbours lie close together; a tree over
them holds, for every eight nodes, the box around their spans. A score can't
exceed that of a block as large as the box (every term grows with the span),
so that branches which can't hold a result are left out. The results are those
of all pairs; a paper's blocks and assets fit one task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 8
#: Roots of a tree, at most.
ROOTS = 32
#: Pairs of queries and nodes that are looked at together; more are split by queries.
PAIRS = 1 << 20


@dataclass
class Level:
    """Nodes over consecutive blocks: the least and the largest of each value, the least index, and a block inside."""

    low_page: np.ndarray
    high_page: np.ndarray
    top: np.ndarray
    bottom: np.ndarray
    low_column: np.ndarray
    high_column: np.ndarray
    cue: np.ndarray
    index: np.ndarray
    inside: np.ndarray


def tree(blocks: pd.DataFrame) -> list[Level]:
    """Levels from the blocks themselves to the roots; blocks with cues are kept apart from those without."""
    b = blocks.sort_values(["cue", "index"])
    get = lambda c, kind: b[c].to_numpy(dtype=kind)
    column, first, last = get("bc", np.int64), get("first_page", np.int64), get("last_page", np.int64)
    levels = [Level(first, last, get("t1", float), get("t2", float), column, column, get("cue", float), get("index", np.int64), np.arange(len(b)))]
    # A null side is passed over by least and greatest: for a node it reaches as far as can be.
    now = Level(**{**vars(levels[0]), "top": np.nan_to_num(levels[0].top, nan=-np.inf), "bottom": np.nan_to_num(levels[0].bottom, nan=np.inf)})
    while len(now.index) > ROOTS:
        at = np.arange(0, len(now.index), FAN)
        least, most = (lambda v: np.minimum.reduceat(v, at)), (lambda v: np.maximum.reduceat(v, at))
        now = Level(least(now.low_page), most(now.high_page), least(now.top), most(now.bottom), least(now.low_column), most(now.high_column), most(now.cue), least(now.index), now.inside[at])
        levels.append(now)
    return levels


Score = Callable[[np.ndarray, Level, np.ndarray], np.ndarray]


def search(n: int, levels: list[Level], score: Score, floor: float, second: bool) -> np.ndarray:
    """For each of ``n`` queries the index of the block with the highest score above ``floor``, ties to the smaller
    index, and of the next one if ``second``; -1 for none.

    ``score(queries, level, nodes)`` is exact for blocks and a bound for nodes.
    """
    found = np.full((n, 2), -1, dtype=np.int64)
    far = np.iinfo(np.int64).max
    depth, roots = len(levels) - 1, len(levels[-1].index)
    step = max(1, PAIRS // roots)
    todo = [(depth, np.repeat(np.arange(i, min(i + step, n)), roots), np.tile(np.arange(roots), min(i + step, n) - i)) for i in range(0, n, step)]
    while todo:
        k, q, node = todo.pop()
        if len(q) > PAIRS and q[0] != q[-1]:
            cut = np.searchsorted(q, q[len(q) // 2])
            cut = cut if cut else np.searchsorted(q, q[0], side="right")
            todo += [(k, q[:cut], node[:cut]), (k, q[cut:], node[cut:])]
            continue
        level = levels[k]
        most = score(q, level, node)
        live = most > floor
        q, node, most = q[live], node[live], most[live]
        if not len(q):
            continue
        block = level.inside[node]
        known = score(q, levels[0], block) if k else most
        index = levels[0].index[block]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        wide = np.diff(np.r_[start, len(q)])
        spread = lambda v: np.repeat(v, wide)

        def leader(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Each query's highest value, its smallest index, and where it is."""
            best = spread(np.maximum.reduceat(value, start))
            at = spread(np.minimum.reduceat(np.where(value == best, index, far), start))
            return best, at, (value == best) & (index == at)

        best, at, is_best = leader(known)
        keep, bar = is_best, best
        if second:
            bar, _, is_next = leader(np.where(is_best, -np.inf, known))
            is_next &= bar > -np.inf
            keep = keep | is_next
        if k == 0:
            found[q[is_best], 0] = index[is_best]
            if second:
                found[q[is_next], 1] = index[is_next]
            continue
        keep = keep | (most > bar) | ((most == best) & (level.index[node] < at))
        q, node = q[keep], node[keep]
        below = len(levels[k - 1].index)
        child = (node[:, None] * FAN + np.arange(FAN)).ravel()
        q = np.repeat(q, FAN)[child < below]
        todo.append((k - 1, q, child[child < below]))
    return found


def _share(a1: np.ndarray, a2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """``geometry.overlap_share`` on arrays."""
    with np.errstate(all="ignore"):
        return np.where(a2 > a1, np.fmax(np.fmin(a2, b2) - np.fmax(a1, b1), 0.0) / (a2 - a1), 0.0)


def _gap(a1: np.ndarray, a2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """``geometry.gap`` on arrays."""
    with np.errstate(all="ignore"):
        return np.where(a2 <= b1, b1 - a2, np.where(b2 <= a1, a1 - b2, 0.0))


def _on_page(page: np.ndarray, level: Level, node: np.ndarray) -> np.ndarray:
    return (level.low_page[node] <= page) & (page <= level.high_page[node])


def asset_score(assets: pd.DataFrame) -> Score:
    """The score of ``layout.assigned``; ``shares`` are an asset's in each column of its page."""
    page = assets["page"].to_numpy(dtype=np.int64)
    x1, y1, x2, y2 = (assets[c].to_numpy(dtype=float) for c in ("x1", "y1", "x2", "y2"))
    wide = x2 - x1 > 0.55
    shares = [() if s is None else s for s in assets["shares"]]
    columns = np.ones((len(assets), max(map(len, shares), default=0) + 1))
    for i, s in enumerate(shares):
        columns[i, : len(s)] = s

    def score(q: np.ndarray, level: Level, node: np.ndarray) -> np.ndarray:
        top, bottom, low, high = level.top[node], level.bottom[node], level.low_column[node], level.high_column[node]
        a1, a2 = y1[q], y2[q]
        up = lambda by: (np.fmax(0.0, top - by), np.fmin(1.0, bottom + by))
        own = np.where(low == high, columns[q, np.minimum(low, columns.shape[1] - 1)], 1.0)
        column = np.where(wide[q] & (_share(a1, a2, *up(0.06)) > 0), 1.0, own)
        near = np.exp(-_gap(a1, a2, top, bottom) / 0.08)
        return 0.35 * _on_page(page[q], level, node) + 0.25 * _share(a1, a2, *up(0.04)) + 0.20 * column + 0.15 * near + 0.05 * level.cue[node]

    return score


def meeting_score(texts: pd.DataFrame) -> Score:
    """1 for blocks on a text's page that overlap its lines but are in another column."""
    page, col = (texts[c].to_numpy(dtype=np.int64) for c in ("page", "col"))
    y1, y2 = (texts[c].to_numpy(dtype=float) for c in ("y1", "y2"))

    def score(q: np.ndarray, level: Level, node: np.ndarray) -> np.ndarray:
        other = (level.low_column[node] != col[q]) | (level.high_column[node] != col[q])
        meets = np.fmin(y2[q], level.bottom[node]) - np.fmax(y1[q], level.top[node]) > 0
        return (_on_page(page[q], level, node) & other & meets).astype(float)

    return score


def _searched(queries: DataFrame, blocks: DataFrame, key: str, of: Callable[[pd.DataFrame], Score], floor: float, second: bool) -> DataFrame:
    b = blocks.select(
        "paper_id", "index", F.element_at("pages", 1).alias("first_page"), F.element_at("pages", -1).alias("last_page"), F.col("column_index").alias("bc"),
        F.get("text_bbox", 1).alias("t1"), F.get("text_bbox", 3).alias("t2"), F.col("cue").cast("double").alias("cue"),
    )

    def run(mine: pd.DataFrame, these: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(these):
            return pd.DataFrame({"paper_id": pd.Series([], dtype=object), key: mine[key].iloc[:0].reset_index(drop=True), "index": pd.Series([], dtype="int64")})
        found = search(len(mine), tree(these), of(mine), floor, second)
        row, place = np.nonzero(found >= 0)
        paper = pd.Series([mine["paper_id"].iloc[0]] * len(row), dtype=object)
        return pd.DataFrame({"paper_id": paper, key: mine[key].to_numpy()[row], "index": found[row, place]})

    kinds = {f.name: f.dataType.simpleString() for f in queries.schema}
    return queries.groupBy("paper_id").cogroup(b.groupBy("paper_id")).applyInPandas(run, f"paper_id {kinds['paper_id']}, {key} {kinds[key]}, index int")


def best_two(assets: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(paper_id, asset_ord, index)``: the two blocks of the paper with the highest scores for each asset."""
    return _searched(assets.select("paper_id", "asset_ord", "page", "x1", "y1", "x2", "y2", "shares"), blocks, "asset_ord", asset_score, -1.0, True)


def first_meeting(texts: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(paper_id, ro, index)``: the first block in another column beside each text that has any."""
    return _searched(texts.select("paper_id", "ro", "page", "col", "y1", "y2"), blocks, "ro", meeting_score, 0.0, False)
