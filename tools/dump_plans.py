"""Write the executed (post-AQE) formatted plans of the key operators.

Usage: python tools/dump_plans.py [sf_dir] [out_dir]
Each plan is captured after running the query, so AQE's final choices
(broadcast vs shuffle, coalesced partitions, skew splits) are visible.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "docs/plans"
    os.makedirs(out, exist_ok=True)

    from pyspark.sql import functions as F

    from cadence.operators import star
    from cadence.operators.checks import run_checks
    from cadence.plans import catalog
    from cadence.plans.models import staging_models
    from cadence.session import build_session, materialise

    spark = build_session("local[8]", 16)
    spark.sparkContext.setLogLevel("ERROR")
    wh = catalog.loaded_warehouse(spark, sf_dir, "lineitem")
    models = staging_models(wh)
    plays, _ = materialise(catalog.cleaned_feed(spark, sf_dir, "lineitem"), "plan-plays")
    cells = star.play_cells(plays)
    big_cells, _ = materialise(cells, "plan-cells")
    stored_songs = star.dim_table(wh, "dim_song")

    plans = {
        "01_feed_and_clean": catalog.cleaned_feed(spark, sf_dir, "lineitem"),
        "02_play_cells": cells,
        "03_dim_song_new_rows": star.new_rows("dim_song", big_cells, plays, stored_songs, False),
        "04_fact_song_stream_single_batch": star.fact_song_stream(wh),
        "05_mart_top_artists": models.mart("mart_top_artists"),
        "06_mart_top_songs": models.mart("mart_top_songs"),
        "07_mart_listening_patterns": models.mart("mart_listening_patterns"),
        "08_check_suite": run_checks({
            "stg_streams": models.stg_streams, "stg_songs": models.stg_songs,
            "stg_artists": models.stg_artists,
            "dim_artist": star.dim_table(wh, "dim_artist"),
            "dim_song": star.dim_table(wh, "dim_song"),
            "dim_date": star.dim_table(wh, "dim_date"),
            "fact_song_stream": star.fact_song_stream(wh)}),
        "09_recent_plays_top50": catalog.q_recent_plays_top50(spark, sf_dir),
        "10_latest_per_artist": catalog.raw_json.latest_plays(
            catalog.event_plays(spark, sf_dir), n=5, per="artist_natural_key"),
    }
    # Compacted months plus one small pending batch: only its months are summed.
    from cadence.session import scratch_path
    from cadence.sources.warehouse import Warehouse
    snap_wh = Warehouse(spark, scratch_path(spark, "plan-snap"))
    month = (F.year("played_at") == 1998) & (F.month("played_at") == 5)
    star.load_star(snap_wh, plays.where(~month), "b1")
    star.load_star(snap_wh, plays.where(month & (F.col("play_id") % 2 == 0)), "b2")
    star.compact(snap_wh)
    star.load_star(snap_wh, plays.where(month & (F.col("play_id") % 2 == 1)), "b3")
    plans["11_fact_months_plus_pending_batch"] = star.fact_song_stream(snap_wh)
    cells_of_may = star.fact_cells(snap_wh).where((F.col("year") == 1998) & (F.col("month") == 5))
    plans["12_fact_one_month_partition_filters"] = cells_of_may

    for name, df in plans.items():
        df._jdf.queryExecution().toRdd().count()   # runs *this* plan, so AQE finalises it
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(f"# {name} at {os.path.basename(sf_dir)} (local[8], executed plan)\n")
            f.write(buf.getvalue())
        print(name, "ok")
    spark.stop()


if __name__ == "__main__":
    main()
