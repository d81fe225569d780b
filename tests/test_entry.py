"""The library without its llm part."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), sorted(n for n in q if n.startswith('op') or n == 'pipeline'))"


@pytest.mark.parametrize("left", ["nothing", "pipeline", "caches"])
def test_entry_without_llm(tmp_path, left):
    """With kartoteka/llm deleted the other queries stay, whether or not corpus_pipeline.py or empty folders are left."""
    own = tmp_path / "own"
    shutil.copytree(ROOT / "kartoteka", own / "kartoteka", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *(["corpus_pipeline.py"] if left != "nothing" else [])):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, own / name)
    if left == "caches":
        (own / "kartoteka" / "llm" / "__pycache__").mkdir(parents=True)
    out = subprocess.run([sys.executable, "-c", ASK], cwd=own, capture_output=True, text=True, timeout=120)
    from kartoteka.plans import registry

    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == f"{len(registry.QUERIES)} {len(registry.ORACLES)} []"


def test_a_cluster_needs_a_shared_folder():
    from kartoteka.operators.shared import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        shared_dir(Session())
