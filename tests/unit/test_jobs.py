"""All six jobs end to end on small text inputs shaped like the reference's."""

import os

from pyspark.sql import functions as F

from screenrank.plans import jobs
from screenrank.session import scratch_path

GENRES = ["Action|Adventure", "Comedy|Drama", "Action|Drama", "Comedy", "Horror|Thriller",
          "Action|Adventure", "Drama|Romance", "Documentary"]


def write_inputs(root):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, "movies.csv"), "w") as f:
        for mid, g in enumerate(GENRES, start=1):
            f.write(f"{mid}^Movie {mid}^about {mid}^90 minutes^2001^1999^English^{g}^Actor^Director\n")
    with open(os.path.join(root, "ratings.csv"), "w") as f:
        for uid in range(1, 13):
            for mid in range(1, 9):
                if (uid + mid) % 3:
                    f.write(f"{uid},{mid},{1 + (uid * mid) % 5}.0,{1000000000 + uid * 1000 + mid}\n")
    with open(os.path.join(root, "tags.csv"), "w") as f:
        f.write("1,1,funny,1139045764\n2,1, funny ,1139045765\n3,2,dark,1139045766\n")


def test_jobs_end_to_end(spark):
    root = scratch_path(spark, "jobs")
    src, tables = os.path.join(root, "src"), os.path.join(root, "tables")
    write_inputs(src)
    jobs.load_job(spark, os.path.join(src, "movies.csv"), os.path.join(src, "ratings.csv"),
                  os.path.join(src, "tags.csv"), tables)
    docs = {r.mid: r.tags for r in spark.read.json(os.path.join(tables, jobs.SEARCH_DOCS_T)).collect()}
    assert docs[1] == "funny" and docs[2] == "dark" and docs[3] is None

    jobs.main(["statistics", "--tables", tables])  # the CLI path, same session
    top = spark.read.parquet(os.path.join(tables, jobs.GENRES_TOP_T)).collect()
    assert {r.genres for r in top} >= {"Action", "Comedy", "Drama"}
    assert all(len(r.recs) <= 10 for r in top)
    for t in (jobs.RATE_MORE_T, jobs.RATE_MORE_RECENT_T, jobs.AVERAGE_T):
        assert spark.read.parquet(os.path.join(tables, t)).count() > 0

    jobs.content_job(spark, tables)
    cs = spark.read.parquet(os.path.join(tables, jobs.CONTENT_RECS_T))
    assert cs.filter(F.col("score") <= 0.6).count() == 0
    pair = cs.filter((F.col("mid") == 1) & (F.col("sim_mid") == 6)).collect()
    assert pair and abs(pair[0].score - 1.0) < 1e-9  # same genres

    jobs.offline_job(spark, tables, rank=3, max_iter=3)
    ur = spark.read.parquet(os.path.join(tables, jobs.USER_RECS_T)).collect()
    assert ur and all(0 < len(r.recs) <= 20 and all(x.score > 0 for x in r.recs) for r in ur)
    mr = spark.read.parquet(os.path.join(tables, jobs.MOVIE_RECS_T))
    assert mr.filter(F.col("score") < 0.6).count() == 0

    grid = jobs.trainer_job(spark, tables, ranks=(2, 3), regs=(0.1,), parallelism=2).collect()
    assert len(grid) == 2 and sum(r.best for r in grid) == 1

    stream_src = os.path.join(root, "stream")
    os.makedirs(stream_src)
    with open(os.path.join(stream_src, "m1.txt"), "w") as f:
        f.write("1|1|5.0|1500000000\n2|3|4.0|1500000001\n")
    q = jobs.realtime_job(spark, tables, stream_src, os.path.join(root, "ckpt"),
                          sim_table=jobs.CONTENT_RECS_T, trigger={"availableNow": True},
                          source_options={"maxFilesPerTrigger": "1"})
    q.awaitTermination()
    from screenrank.streaming.recommender import current_recs
    recs = {r.uid: r.recs for r in current_recs(spark, os.path.join(tables, jobs.STREAM_RECS_T)).collect()}
    assert set(recs) == {1, 2}


def test_quarantine_needs_a_folder_and_keeps_bad_lines(spark):
    import pytest

    root = scratch_path(spark, "jobs-bad")
    src, tables = os.path.join(root, "src"), os.path.join(root, "tables")
    write_inputs(src)
    with open(os.path.join(src, "ratings.csv"), "a") as f:
        f.write("x,1,2.0,3\n")
    paths = [os.path.join(src, f"{n}.csv") for n in ("movies", "ratings", "tags")]
    with pytest.raises(ValueError, match="quarantine_dir"):
        jobs.load_job(spark, *paths, tables, mode="quarantine")
    jobs.load_job(spark, *paths, tables, mode="quarantine", quarantine_dir=os.path.join(root, "bad"))
    assert [r.value for r in spark.read.parquet(os.path.join(root, "bad", jobs.RATING_T)).collect()] == ["x,1,2.0,3"]
