import subprocess
import sys

from pyspark import cloudpickle

from screenrank.operators import similarity


def test_worker_functions_unpickle_without_the_package():
    blob = cloudpickle.dumps(similarity._cosine_block_pairs(0.5, True, 3))
    code = ("import sys, pickle; sys.path = [p for p in sys.path if 'repo' not in p]; "
            "f = pickle.loads(sys.stdin.buffer.read()); print(callable(f))")
    out = subprocess.run([sys.executable, "-c", code], input=blob, capture_output=True, cwd="/tmp",
                         timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-2000:]
    assert out.stdout.strip() == b"True"


def test_state_processor_unpickles_without_the_package():
    from screenrank.streaming.stateful import UserProfile

    blob = cloudpickle.dumps(UserProfile())
    code = ("import sys, pickle; sys.path = [p for p in sys.path if 'repo' not in p]; "
            "p = pickle.loads(sys.stdin.buffer.read()); print(p.n_recent)")
    out = subprocess.run([sys.executable, "-c", code], input=blob, capture_output=True, cwd="/tmp",
                         timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-2000:]
    assert out.stdout.strip() == b"20"
