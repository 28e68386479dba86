"""Landed municipality payload to the validated dimension."""

from __future__ import annotations

from pyspark.sql import SparkSession

from litro.operators.municipalities import ambiguous_match_keys, flatten_municipalities
from litro.operators.quality import validate_dimension
from litro.session import scratch_folder, stage
from litro.sources.layers import write_dimension
from litro.sources.municipalities import read_municipalities


def build_dimension(spark: SparkSession, payload: str, target: str) -> str:
    """Reads the payload once; a match key of several municipalities would count prices twice, so it is refused."""
    with scratch_folder(spark, "dimension") as work:
        dimension = stage(flatten_municipalities(read_municipalities(spark, payload)), work)
        validate_dimension(dimension)
        if shared := ambiguous_match_keys(dimension).limit(20).collect():
            raise ValueError(f"Match keys of several municipalities: {[(r.uf, r.municipio_match) for r in shared]}")
        write_dimension(dimension, target)
    return target
