"""The entry file without the optional corpus folders, in a copy of the repository."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as E, json; print(json.dumps([sorted(E.queries()), sorted(E.oracle_sql())]))"


def _keys(folder, **env):
    done = subprocess.run([sys.executable, "-c", SAYS], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)} | env)
    assert done.returncode == 0, done.stderr
    return __import__("json").loads(done.stdout.splitlines()[-1])


def _copy(tmp_path, *left_out):
    skip = {os.path.join(ROOT, p) for p in left_out}
    dest = tmp_path / "repo"
    shutil.copytree(ROOT, dest, ignore=lambda d, names: [n for n in names if os.path.join(d, n) in skip or n in (".git", "__pycache__")])
    return dest


def test_rest_works_without_the_corpus_folders(tmp_path):
    from panelkit.registry.all import all_oracle, all_queries

    for left_out in (("panelkit/llm", "tests/llm", "corpus_pipeline.py"), ("panelkit/llm", "tests/llm")):
        base = tmp_path / str(len(left_out))
        base.mkdir()
        queries, oracle = _keys(_copy(base, *left_out))
        assert queries == sorted(all_queries()) and oracle == sorted(all_oracle())


def test_rest_works_without_the_tokenizer_files(tmp_path):
    from panelkit.registry.all import all_queries

    dest = _copy(tmp_path)
    (dest / "public_tokenizers.py").write_text("raise ImportError('not here')\n")
    queries, _ = _keys(dest)
    assert set(all_queries()) <= set(queries) and not any(q.startswith("op4") for q in queries)


def test_nothing_outside_imports_the_corpus_operators():
    for folder, _, files in os.walk(os.path.join(ROOT, "panelkit")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    assert "panelkit.llm" not in open(os.path.join(folder, name)).read(), name
