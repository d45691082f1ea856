import hashlib
import http.server
import threading

import pytest
from pyspark.sql import functions as F

from chainloom import config
from chainloom.operators.selectors import Selection, select_blocks
from chainloom.operators.shred import TABLES
from chainloom.sources.http import fetch
from chainloom.streaming import jobs, monitor
from tests.test_chain import chain


def test_file_environment_and_checks(tmp_path):
    path = tmp_path / "s.toml"
    path.write_text('source = "a"\ntarget = "b"\n[performance]\nmode = "manual"\nmanual_workers = 99\n[components]\nmetadata_labels = [721]\n')
    s = config.load(str(path), {"CHAINLOOM_TARGET": "c", "CHAINLOOM_COMPONENTS_SCRIPTS": "no", "CHAINLOOM_PERFORMANCE_MAX_BATCH": "700"})
    assert (s.source, s.target, s.components.metadata_labels, s.components.scripts) == ("a", "c", [721], False)
    assert s.performance.active(300) == {"workers": 16, "connections": 64, "batch": 700, "queue": 10000, "fetch_range": 2000}
    assert "scripts" not in s.components.tables() and s.components.tables() <= set(TABLES) | {"treasuries", "committee_registrations"}
    for bad in ({}, {"CHAINLOOM_SOURCE": "a"}, {"CHAINLOOM_SOURCE": "a", "CHAINLOOM_TARGET": "b", "CHAINLOOM_PERFORMANCE_MODE": "fast"}):
        with pytest.raises(ValueError):
            config.load(None, bad)


@pytest.mark.parametrize("mode, epoch, workers, batch", [("auto", 100, 16, 2000), ("auto", 300, 8, 500), ("aggressive", 300, 16, 5000), ("conservative", 300, 4, 500)])
def test_modes(mode, epoch, workers, batch):
    got = config.Performance(mode=mode).active(epoch)
    assert (got["workers"], got["batch"]) == (workers, batch)


def test_selection(spark):
    raw = chain(spark)
    assert select_blocks(raw, Selection(first_slot=5_000_010)).count() == 1
    size = lambda s: select_blocks(raw, s).agg(F.sum(F.size("txs"))).first()[0]
    assert size(Selection()) == 1 and size(Selection(addresses=["a2"])) == 1 and size(Selection(addresses=["zz"])) == 0
    assert size(Selection(policies=["aa" * 28], metadata_keys=[721])) == 1 and size(Selection(metadata_keys=[1])) == 0


def test_fetching(spark):
    class Answer(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            self.send_response(404 if self.path == "/gone" else 200)
            self.end_headers()
            self.wfile.write(b"body")

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    good = hashlib.sha256(b"body").hexdigest()
    refs = spark.createDataFrame([(1, f"{base}/x", good), (2, f"{base}/x", "00"), (3, f"{base}/gone", good), (4, "ftp://x/y", good), (5, "http://127.0.0.1:1/", good)], "id long, url string, hash string")
    got = {r["id"]: r for r in fetch(refs, "id", rate=1000, pause=0.01).collect()}
    server.shutdown()
    assert got[1]["valid"] and got[1]["attempts"] == 1 and not got[2]["valid"] and bytes(got[2]["body"]) == b"body"
    assert got[3]["error"] == "status 404" and got[4]["error"] == "scheme not allowed" and got[4]["attempts"] == 0 and got[5]["attempts"] == 3


def test_jobs_of_epochs_run_when_the_next_begins_and_go_on_after_a_restart(spark, tmp_path):
    ran = []

    def job(blocks, epoch):
        ran.append(epoch)
        return blocks.groupBy("epoch_no").agg(F.count(F.lit(1)).alias("n"))

    def run(epochs, number):
        spark.createDataFrame([(e,) for e in epochs], "epoch_no long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        done = monitor.EpochJobs(f"file://{tmp_path}/jobs", "epoch_no long", "epoch_no", job, "epoch_no long, n long")
        log = monitor.ProgressLog()
        spark.streams.addListener(log)
        jobs.replay(spark, f"{tmp_path}/in").writeStream.foreachBatch(done.step).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
        spark.streams.removeListener(log)
        return done

    run([8, 9, 9], 0)
    assert ran == ["8"]
    run([9, 10, 10, 12], 1)
    assert ran == ["8", "9", "10"]
    done = run([9], 2)  # late
    assert ran == ["8", "9", "10", "9"]
    assert sorted(map(tuple, done.finish(spark).collect())) == [(8, 1), (9, 4), (10, 2), (12, 1)]
    assert monitor.near_tip(100, 3700) and not monitor.near_tip(100, 3701)
