"""Compile the Java sources next to this file into ``geo.jar``: ``python -m landcarbon.functions.build_jar``.

Needed only after a change to the sources; the jar is kept in the repository.
"""

import subprocess
import tempfile
import zipfile
from pathlib import Path

import pyspark

HERE = Path(__file__).parent


def build() -> Path:
    jars = Path(pyspark.__path__[0]) / "jars"
    sources = sorted(str(p) for p in (HERE / "java").rglob("*.java"))
    target = HERE / "geo.jar"
    with tempfile.TemporaryDirectory() as out:
        subprocess.run(
            ["javac", "--release", "17", "-proc:none", "-cp", f"{jars}/*", "-d", out, *sources], check=True
        )
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as jar:
            for cls in sorted(Path(out).rglob("*.class")):
                # A fixed date keeps the jar the same for the same sources.
                info = zipfile.ZipInfo(str(cls.relative_to(out)), (2020, 1, 1, 0, 0, 0))
                info.compress_type = zipfile.ZIP_DEFLATED
                jar.writestr(info, cls.read_bytes())
    return target


if __name__ == "__main__":
    print(build())
