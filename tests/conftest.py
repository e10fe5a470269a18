import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])  # for Spark's Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from wardflow.session import local_session
    return local_session("8", work_dir=str(tmp_path_factory.mktemp("stage")))
