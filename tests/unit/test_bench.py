import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="rating_avg,genre_top10", BENCH_WARMUP="0", BENCH_DRIVER_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, timeout=600)
    assert out.returncode == 0, out.stderr.decode()[-2000:]
    lines = [l for l in out.stdout.decode().splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"rating_avg", "genre_top10"}
    assert rec["value"] > 0 and rec["sf"] == "0.001"
