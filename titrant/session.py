"""The session settings that the library's operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # merging profiles and sections: the last writer of a key wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(app: str = "titrant", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return configure(builder.config(map=SETTINGS | {k.replace("_", "."): v for k, v in more.items()}).getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Set what operators need on a session that someone else made."""
    for key, value in SETTINGS.items():
        if not key.startswith("spark.sql.adaptive"):
            spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package: it goes to every executor with the session's files, once, unless PYTHONPATH has it for all."""
    import os
    import tempfile
    import zipfile
    from pathlib import Path

    package = Path(__file__).resolve().parent
    context = spark.sparkContext
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_titrant_shipped", False):
        return spark
    target = Path(tempfile.mkdtemp(prefix="titrant-")).resolve() / "titrant.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*")):
            if f.suffix in (".py", ".yaml"):
                z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(target))
    context._titrant_shipped = True
    return spark
