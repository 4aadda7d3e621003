"""The command line runs a flow in its own Spark process."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_api_cycle_command(scratch):
    root = scratch("cli")
    env = dict(os.environ, PYTHONPATH=ROOT)
    cmd = [sys.executable, "-m", "tessera", "api-cycle", "--sf-dir", "/root/testdata/sf0.001",
           "--root", root, "--run-id", "1", "--stamp", "2024-01-31 00:00:00",
           "--master", "local[2]"]
    out = subprocess.run(cmd, env=env, capture_output=True, text=True, timeout=600, check=True)
    report = json.loads(out.stdout.strip().splitlines()[-1])
    assert report.pop("lines") == report.pop("loaded") > 0
    assert report == {"run_id": "1", "silver_write": "append", "expired": 0, "forgotten": 0, "rejected": 0}
    again = subprocess.run(cmd, env=env, capture_output=True, text=True, timeout=600, check=True)
    # a finished run is not run again
    assert json.loads(again.stdout.strip().splitlines()[-1])["silver_write"] == "finished before"


def test_stream_command_reads_a_given_topic_once(scratch):
    root, topic = scratch("cli-stream"), scratch("cli-topic")
    os.makedirs(topic)
    with open(f"{topic}/a.txt", "w") as f:
        f.write('{"id": 1, "vessel_id": 2, "raw_force_reading": 0.5, "location_id": 3, "event_time": "2026-03-18T10:00:00Z"}\n'
                '{"id": 2, "vessel_id": 2, "raw_force_reading": 0.5, "location_id": 3, "event_time": "12:30"}\n')
    cmd = [sys.executable, "-m", "tessera", "stream", "--topic", topic, "--root", root, "--available-now",
           "--master", "local[2]"]
    for _ in range(2):
        subprocess.run(cmd, env=dict(os.environ, PYTHONPATH=ROOT), capture_output=True, text=True, timeout=600, check=True)
    import pyarrow.dataset as ds
    assert ds.dataset(f"{root}/silver", format="parquet").count_rows() == 1
    assert ds.dataset(f"{root}/dead_letters", format="parquet").count_rows() == 1
