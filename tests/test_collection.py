import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_every_test_file_can_be_collected():
    """One command collects all folders: no module of one hides a module of another."""
    run = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", HERE], capture_output=True, text=True,
                         cwd=os.path.dirname(HERE), timeout=120)
    assert run.returncode == 0, run.stdout[-2000:]
