import os
import re
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_llm_part(tmp_path):
    for name in ("__spark_entry__.py", "fieldloom"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 70 and not any(n.startswith('op') for n in q), sorted(q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_llm_part():
    for top, dirs, names in os.walk(os.path.join(ROOT, "fieldloom")):
        dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
        for n in names:
            if n.endswith(".py"):
                text = open(os.path.join(top, n)).read()
                assert not re.search(r"(import|from) .*\bllm\b", text), n
