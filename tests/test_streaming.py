from fixture_a import FIRST_COMMIT, SECOND_COMMIT, txn_df
from keelson.session import work_dir
from keelson.sinks import versions as lake_commit
from keelson.streaming.commit_watch import watch_commits


def test_watcher_sees_each_new_commit_once(spark):
    path = work_dir(spark, "t-stream-lake")
    ckpt = work_dir(spark, "t-stream-ckpt")
    seen = []
    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), path)
    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), path)
    q = watch_commits(spark, path, seen.append, ckpt)
    q.awaitTermination(120)
    assert seen and seen[-1] == 1

    q = watch_commits(spark, path, seen.append, ckpt)  # nothing new
    q.awaitTermination(120)
    n = len(seen)

    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), path)
    q = watch_commits(spark, path, seen.append, ckpt)
    q.awaitTermination(120)
    assert len(seen) == n + 1 and seen[-1] == 2


def test_watcher_drives_the_stage_and_merge_job(spark):
    from fixture_a import customers_df
    from keelson.plans import jobs

    root = work_dir(spark, "t-stream-job")
    lake = f"{root}/lake"
    wh = jobs.Warehouse.create(spark, root)
    runs = []

    def on_version(v):
        runs.append((v, jobs.stage_and_merge(spark, lake, wh, customers_df(spark), "dev")))

    lake_commit.commit_overwrite(txn_df(spark, FIRST_COMMIT), lake)
    lake_commit.commit_append(txn_df(spark, SECOND_COMMIT), lake)
    watch_commits(spark, lake, on_version, f"{root}/watch").awaitTermination(300)
    assert [v for v, _ in runs] == [1]
    assert runs[0][1]["merge"]["insert"] == 8
    lake_commit.commit_overwrite(txn_df(spark, SECOND_COMMIT), lake)  # v2: only three rows staged
    watch_commits(spark, lake, on_version, f"{root}/watch").awaitTermination(300)
    assert [v for v, _ in runs] == [1, 2]
    m = runs[1][1]["merge"]
    # target 001..007 with TXN-003 twice; staging 003, 006, 007: 001, 002, 004, 005 kept,
    # the refunded TXN-003 row is updated, the other three matched rows are unchanged
    assert runs[1][1]["staged_rows"] == 3 and m["keep"] == 4 and m["update"] == 1 and m["noop"] == 3
