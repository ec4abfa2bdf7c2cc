"""Session options that follow from the size of the input."""

from __future__ import annotations

_MIB = 1024 * 1024
_SHUFFLE_PARTITION = 256 * _MIB
# Keys, flags and measures are about a tenth of the bytes that a table holds.
_SHUFFLED_SHARE = 0.1
_MOST_PARTITIONS = 50_000


def recommended_options(input_bytes: int, cores: int) -> dict[str, str]:
    """Options for an analysis of ``input_bytes`` of Parquet on ``cores`` cores.

    Shuffle partitions of a quarter GiB fit an executor's share of memory; the
    adaptive planner merges those that turn out small and splits skewed ones.
    """
    wanted = int(input_bytes * _SHUFFLED_SHARE / _SHUFFLE_PARTITION)
    partitions = min(max(wanted, cores), _MOST_PARTITIONS)
    scan = 512 * _MIB if input_bytes > 10 * 1024 * 1024 * _MIB else 128 * _MIB
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_SHUFFLE_PARTITION // 2),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.session.timeZone": "UTC",
    }
