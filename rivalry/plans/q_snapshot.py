"""Queries over SCD2 snapshots: two runs over changing model versions.

Run 1 (2024-01-01) sees the games before 2000-01-01; run 2 (2024-01-02)
sees every game not involving ``NATION_3``: keys appear, change and vanish.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.operators.snapshot import as_of, snapshot
from rivalry.plans import fixtures as X
from rivalry.plans import oracle as O
from rivalry.plans.catalog import register
from rivalry.plans.models import (build_biggest_win_loss, build_close_game_season_stats,
                                  build_team_season_stats)
from rivalry.plans.refresh import SNAPSHOTS
from rivalry.plans.refresh import summary, refresh
from rivalry.schemas import (BIGGEST_WIN_LOSS_COLS, CLOSE_GAME_STATS_COLS, TEAM_SEASON_STATS_COLS)
from rivalry.session import work_dir

# Fixed values of the snapshot scenario.
TS1, TS2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
AS_OF = "2024-01-01 12:00:00"
CUTOFF = "2000-01-01"
DROPPED = "NATION_3"


def _v1(spark, sf_dir):
    return X.games(spark, sf_dir).filter(F.col("date") < F.lit(CUTOFF).cast("date"))


def _v2(spark, sf_dir):
    g = X.games(spark, sf_dir)
    return g.filter((F.col("home_team") != DROPPED) & (F.col("away_team") != DROPPED))


V_CTES = {
    "games": O.GAMES,
    "g1": f"SELECT * FROM games WHERE date < DATE '{CUTOFF}'",
    "g2": f"SELECT * FROM games WHERE home_team <> '{DROPPED}' AND away_team <> '{DROPPED}'",
    "r1": O.team_results_sql("g1"),
    "r2": O.team_results_sql("g2"),
}


def snapshot_sql(v1: str, v2: str, keys: list[str], cols: list[str], strategy: str,
                 hard: bool, check: list[str] | None = None, updated_at: str | None = None) -> dict:
    """CTEs ``snap1`` (after run 1) and ``snap2`` (after run 2) over sources ``v1``/``v2``."""
    def vf(alias):
        return f"TIMESTAMP '{TS1}'" if strategy == "check" else f"CAST({alias}.{updated_at} AS TIMESTAMP)"

    def sid(alias, vf_expr):
        ks = ", ".join(f"CAST({alias}.{k} AS VARCHAR)" for k in keys)
        return f"md5(concat_ws('|', {ks}, CAST({vf_expr} AS VARCHAR)))"

    collist = ", ".join(f"v.{c}" for c in cols)
    snap1 = (f"SELECT {collist}, {sid('v', vf('v'))} AS scd_id, {vf('v')} AS updated_at, "
             f"{vf('v')} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM {v1} v")
    on = " AND ".join(f"o.{k} = s.{k}" for k in keys)
    vf2 = f"TIMESTAMP '{TS2}'" if strategy == "check" else f"CAST(s.{updated_at} AS TIMESTAMP)"
    if strategy == "check":
        same = " AND ".join(f"o.{c} IS NOT DISTINCT FROM s.{c}" for c in check)
        changed = f"(o.scd_id IS NOT NULL AND s.hit AND NOT ({same}))"
        close = f"TIMESTAMP '{TS2}'"
    else:
        changed = f"(o.scd_id IS NOT NULL AND s.hit AND {vf2} > o.valid_from)"
        close = vf2
    gone = "(o.scd_id IS NOT NULL AND s.hit IS NULL)"
    vt = f"CASE WHEN {changed} THEN {close} " + (f"WHEN {gone} THEN TIMESTAMP '{TS2}' " if hard else "") \
         + "ELSE o.valid_to END"
    ocols = ", ".join(f"o.{c}" for c in cols)
    scols = ", ".join(f"s.{c}" for c in cols)
    j = f"snap1 o FULL OUTER JOIN (SELECT *, TRUE AS hit FROM {v2}) s ON {on}"
    snap2 = (f"SELECT {ocols}, o.scd_id, o.updated_at, o.valid_from, {vt} AS valid_to FROM {j} "
             f"WHERE o.scd_id IS NOT NULL\nUNION ALL\n"
             f"SELECT {scols}, {sid('s', vf2)}, {vf2}, {vf2}, CAST(NULL AS TIMESTAMP) FROM {j} "
             f"WHERE s.hit AND (o.scd_id IS NULL OR {changed})")
    return {"snap1": snap1, "snap2": snap2}


STATS_CFG = SNAPSHOTS["snapshot_team_season_stats"]
CLOSE_CFG = SNAPSHOTS["snapshot_close_game_season_stats"]
EXT_CFG = SNAPSHOTS["snapshot_team_season_biggest_win_loss"]


def _stats_ctes():
    return {**V_CTES, "m1": O.team_season_stats_sql("r1"), "m2": O.team_season_stats_sql("r2"),
            **snapshot_sql("m1", "m2", STATS_CFG["keys"], TEAM_SEASON_STATS_COLS, "check", False,
                           check=STATS_CFG["check_cols"])}


def _close_ctes():
    return {**V_CTES, "m1": O.close_game_stats_sql("r1"), "m2": O.close_game_stats_sql("r2"),
            **snapshot_sql("m1", "m2", CLOSE_CFG["keys"], CLOSE_GAME_STATS_COLS, "check", False,
                           check=CLOSE_CFG["check_cols"])}


def _ext_ctes(hard: bool):
    return {**V_CTES, "m1": O.biggest_win_loss_sql("r1"), "m2": O.biggest_win_loss_sql("r2"),
            **snapshot_sql("m1", "m2", EXT_CFG["keys"], BIGGEST_WIN_LOSS_COLS, "timestamp", hard,
                           updated_at="date")}


def _two_runs(m1, m2, cfg, hard=None):
    kw = dict(strategy=cfg["strategy"], check_cols=cfg.get("check_cols"),
              updated_at=cfg.get("updated_at"),
              hard_deletes=cfg.get("hard_deletes", False) if hard is None else hard)
    s1 = snapshot(None, m1, cfg["keys"], TS1, **kw)
    return snapshot(s1, m2, cfg["keys"], TS2, **kw)


@register("snapshot_check", O.with_ctes("SELECT * FROM snap2", **_stats_ctes()))
def q_snapshot_check(spark, sf_dir):
    return _two_runs(build_team_season_stats(_v1(spark, sf_dir)),
                     build_team_season_stats(_v2(spark, sf_dir)), STATS_CFG)


@register("snapshot_close_games", O.with_ctes("SELECT * FROM snap2", **_close_ctes()))
def q_snapshot_close_games(spark, sf_dir):
    return _two_runs(build_close_game_season_stats(_v1(spark, sf_dir)),
                     build_close_game_season_stats(_v2(spark, sf_dir)), CLOSE_CFG)


@register("snapshot_timestamp", O.with_ctes("SELECT * FROM snap2", **_ext_ctes(False)))
def q_snapshot_timestamp(spark, sf_dir):
    return _two_runs(build_biggest_win_loss(_v1(spark, sf_dir)),
                     build_biggest_win_loss(_v2(spark, sf_dir)), EXT_CFG, hard=False)


@register("snapshot_hard_delete", O.with_ctes("SELECT * FROM snap2", **_ext_ctes(True)))
def q_snapshot_hard_delete(spark, sf_dir):
    return _two_runs(build_biggest_win_loss(_v1(spark, sf_dir)),
                     build_biggest_win_loss(_v2(spark, sf_dir)), EXT_CFG, hard=True)


@register("snapshot_as_of", O.with_ctes(
    f"SELECT * FROM snap2 WHERE valid_from <= TIMESTAMP '{AS_OF}' "
    f"AND (valid_to IS NULL OR TIMESTAMP '{AS_OF}' < valid_to)", **_stats_ctes()))
def q_snapshot_as_of(spark, sf_dir):
    return as_of(q_snapshot_check(spark, sf_dir), AS_OF)


def _stored(spark, m1, m2, cfg, name):
    from rivalry.sources.history import SnapshotStore
    store = SnapshotStore(spark, work_dir(spark, name))
    kw = {k: v for k, v in cfg.items() if k not in ("model", "keys")}
    store.run(m1, cfg["keys"], TS1, **kw)
    store.run(m2, cfg["keys"], TS2, **kw)
    return store


@register("snapshot_stored", O.with_ctes("SELECT * FROM snap2", **_ext_ctes(True)))
def q_snapshot_stored(spark, sf_dir):
    """Two runs of the extremes' snapshot in the append-only store."""
    return _stored(spark, build_biggest_win_loss(_v1(spark, sf_dir)), build_biggest_win_loss(_v2(spark, sf_dir)),
                   EXT_CFG, "stored-extremes").read()


@register("snapshot_stored_as_of", O.with_ctes(
    f"SELECT * FROM snap2 WHERE valid_from <= TIMESTAMP '{AS_OF}' "
    f"AND (valid_to IS NULL OR TIMESTAMP '{AS_OF}' < valid_to)", **_stats_ctes()))
def q_snapshot_stored_as_of(spark, sf_dir):
    """The statistics between two runs, from the append-only store: open rows and the overlapping closed folders."""
    return _stored(spark, build_team_season_stats(_v1(spark, sf_dir)), build_team_season_stats(_v2(spark, sf_dir)),
                   STATS_CFG, "stored-stats").as_of(AS_OF)


def _refresh_sql() -> str:
    c = {**V_CTES,
         "m1": O.team_season_stats_sql("r1"), "m2": O.team_season_stats_sql("r2")}
    s = snapshot_sql("m1", "m2", STATS_CFG["keys"], TEAM_SEASON_STATS_COLS, "check", False,
                     check=STATS_CFG["check_cols"])
    c["stats_snap"] = s["snap2"].replace("snap1", "stats_snap1")
    c = {**{k: v for k, v in c.items() if k != "stats_snap"}, "stats_snap1": s["snap1"],
         "stats_snap": c["stats_snap"]}
    cm1, cm2 = O.close_game_stats_sql("r1"), O.close_game_stats_sql("r2")
    cs = snapshot_sql("cm1", "cm2", CLOSE_CFG["keys"], CLOSE_GAME_STATS_COLS, "check", False,
                      check=CLOSE_CFG["check_cols"])
    es = snapshot_sql("em1", "em2", EXT_CFG["keys"], BIGGEST_WIN_LOSS_COLS, "timestamp", True,
                      updated_at="date")
    c.update({"cm1": cm1, "cm2": cm2, "close_snap1": cs["snap1"],
              "close_snap": cs["snap2"].replace("snap1", "close_snap1"),
              "em1": O.biggest_win_loss_sql("r1"), "em2": O.biggest_win_loss_sql("r2"),
              "ext_snap1": es["snap1"], "ext_snap": es["snap2"].replace("snap1", "ext_snap1")})
    body = "\nUNION ALL\n".join([
        "SELECT 'team_season_stats' AS artifact, COUNT(*) AS rows, COUNT(*) AS open_rows FROM m2",
        "SELECT 'close_game_season_stats', COUNT(*), COUNT(*) FROM cm2",
        "SELECT 'team_season_biggest_win_loss', COUNT(*), COUNT(*) FROM em2",
        "SELECT 'snapshot_team_season_stats', COUNT(*), CAST(COUNT(*) FILTER (WHERE valid_to IS NULL) AS BIGINT) FROM stats_snap",
        "SELECT 'snapshot_close_game_season_stats', COUNT(*), CAST(COUNT(*) FILTER (WHERE valid_to IS NULL) AS BIGINT) FROM close_snap",
        "SELECT 'snapshot_team_season_biggest_win_loss', COUNT(*), CAST(COUNT(*) FILTER (WHERE valid_to IS NULL) AS BIGINT) FROM ext_snap",
    ])
    return O.with_ctes(body, **c)


@register("refresh_report", _refresh_sql())
def q_refresh_report(spark, sf_dir):
    """Two scheduled refreshes (build -> test gate -> snapshot) into versioned tables."""
    root = work_dir(spark, "refresh")
    refresh(spark, _v1(spark, sf_dir), root, TS1)
    refresh(spark, _v2(spark, sf_dir), root, TS2)
    names = ["team_season_stats", "close_game_season_stats", "team_season_biggest_win_loss",
             *SNAPSHOTS]
    return summary(spark, root, names)


def _daily_cycle_sql() -> str:
    from rivalry.plans.q_ingest import INCREMENT_FROM, MERGE_TARGET, STAGE_LATEST, STAGE_RAW, merge_sql
    c = {"games": O.GAMES, "target": MERGE_TARGET,
         "stage_raw": STAGE_RAW.replace(
             "WHERE (home_score + away_score) % 11 <> 0",
             f"WHERE (home_score + away_score) % 11 <> 0 AND date >= DATE '{INCREMENT_FROM}'"),
         "stage": STAGE_LATEST, "merged": merge_sql("target", "stage"),
         "r1": O.team_results_sql("target"), "r2": O.team_results_sql("merged"),
         "m1": O.team_season_stats_sql("r1"), "m2": O.team_season_stats_sql("r2")}
    c.update(snapshot_sql("m1", "m2", STATS_CFG["keys"], TEAM_SEASON_STATS_COLS, "check", False,
                          check=STATS_CFG["check_cols"]))
    return O.with_ctes("SELECT * FROM snap2", **c)


@register("daily_cycle_snapshot", _daily_cycle_sql())
def q_daily_cycle_snapshot(spark, sf_dir):
    """One incremental day: load payloads, MERGE, recompute touched seasons, test, snapshot."""
    from rivalry.plans import incremental as I
    from rivalry.plans.q_ingest import FIXTURE_UNIT, INCREMENT_FROM
    from rivalry.plans.refresh import test_and_snapshot
    from rivalry.sources.partitioned import write_partitioned
    from rivalry.sources.store import VersionedTable
    base = work_dir(spark, "cycle")
    fact, root, landing = f"{base}/games", f"{base}/models", f"{base}/landing"
    write_partitioned(X.merge_target(spark, sf_dir), fact, unit=FIXTURE_UNIT)
    I.publish_all(spark, I.current_fact(spark, fact), root)
    test_and_snapshot(spark, root, I.MODEL_NAMES, TS1)
    (X.payload_documents(spark, sf_dir)
       .filter(F.col("parameters.date") >= F.lit(INCREMENT_FROM)).write.json(landing))
    I.daily_cycle(spark, landing, fact, root, TS2)
    return VersionedTable(spark, f"{root}/snapshot_team_season_stats").read()
