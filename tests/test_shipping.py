"""What runs in tasks must load on an executor that has no copy of the package."""
import subprocess
import sys

from pyspark import cloudpickle

from docquery.operators import search


def test_task_code_travels_by_value(tmp_path):
    sent = tmp_path / "sent"
    sent.write_bytes(cloudpickle.dumps((search._Best, search._matrix)))
    load = f"import pickle; print(pickle.load(open({str(sent)!r}, 'rb'))[0].__name__)"
    done = subprocess.run([sys.executable, "-c", load], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "_Best", done.stderr
