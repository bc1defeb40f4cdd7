"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

# Runtime settings that change results.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Duplicate keys in a JSON object: the last one wins instead of the line being rejected.
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# Runtime settings that keep hot keys apart; sizes and partition counts are left to the cluster's configuration.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs another shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# The documented limit beyond which HotSpot no longer compiles a generated method: larger stages are better split up.
CODEGEN_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session."""
    for key, value in {**RESULT_SETTINGS, **SKEW_SETTINGS, **CODEGEN_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Keyed state of streams on the local disks, with a share of the memory that does not grow. Its keys are not counted, which
# would cost one more look-up each. A micro-batch adds its changes to the checkpoint, the whole state follows after a hundred
# of them: it is new files each time, because compaction rewrites them. What the last two batches do not need goes within
# seconds, as does the local copy when the stream has ended.
_STREAMING = "spark.sql.streaming"
_ROCKSDB = f"{_STREAMING}.stateStore.rocksdb"
STATE_SETTINGS = {
    f"{_STREAMING}.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKSDB}.boundedMemoryUsage": "true",
    f"{_ROCKSDB}.trackTotalNumberOfRows": "false",
    f"{_ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{_STREAMING}.stateStore.minDeltasForSnapshot": "100",
    f"{_ROCKSDB}.compression": "zstd",
    f"{_ROCKSDB}.blockSizeKB": "32",
    f"{_STREAMING}.stateStore.compression.codec": "zstd",
    f"{_STREAMING}.stateStore.maintenanceInterval": "10s",
    f"{_STREAMING}.minBatchesToRetain": "2",
}


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def expression_code(spark: SparkSession) -> AbstractContextManager[None]:
    """Plans made inside compile expression by expression, in small methods, instead of one method per stage.

    For stages whose joint code is beyond what the JVM compiles: they would fail to compile first and run slower then.
    """
    return _settings(spark, {"spark.sql.codegen.wholeStage": "false"})


def state_on_disk(spark: SparkSession) -> AbstractContextManager[None]:
    """Streams started inside keep their keyed state on disk; one that is resumed keeps the store it began with.

    Each part of the state takes 4 MB of disk while it is empty, so there are at most four for each core.
    """
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return _settings(spark, {**STATE_SETTINGS, "spark.sql.shuffle.partitions": str(parts)})


def shuffles_go(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of plans made inside go when the action that wrote them ends, not when the driver collects its garbage."""
    return _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def adaptive(spark: SparkSession) -> AbstractContextManager[None]:
    """Plans made inside adapt to sizes, also in a micro-batch, where streams with state switch that off."""
    return _settings(spark, {"spark.sql.adaptive.enabled": "true"})


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("clickfacts")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.clickfacts.tasks", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())
