"""Ingestion: bodies to validation results to raw events, dead letters, acknowledgements and audit records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig
from pulsegrid.contracts import UnreadableContract
from pulsegrid.operators import audit, enrich, route
from pulsegrid.operators.validate import latest_versions, validate
from pulsegrid.schemas import ORIGIN, RAW_CONTRACT, Contract


def messages(
    bodies: DataFrame, config: IngestConfig = IngestConfig(), contract: Contract = RAW_CONTRACT,
    *, as_of: Column | None = None,
) -> DataFrame:
    """All messages of a batch or a stream of bodies, in one pass: raw or dead letter, acknowledgement, audit."""
    return route.ingest_messages(
        validate(bodies, config, contract), config, as_of=as_of, audit=audit.ingest_records(config, as_of=as_of))


def outcomes(
    bodies: DataFrame, config: IngestConfig = IngestConfig(), contract: Contract = RAW_CONTRACT,
    *, as_of: Column | None = None,
) -> DataFrame:
    """One row per body with its ``route`` (accepted or rejected), the ``event`` or the ``letter``, and the ``ack``.

    One table instead of three, so the texts are decoded once whatever is
    taken from it; a write partitioned by ``route`` lays both sides out.
    """
    valid = F.col("valid")
    return validate(bodies, config, contract).select(
        *ORIGIN,
        F.when(valid, F.lit("accepted")).otherwise(F.lit("rejected")).alias("route"),
        F.when(valid, enrich.enriched_event(config, as_of)).alias("event"),
        F.when(~valid, enrich.dead_letter(config, as_of)).alias("letter"),
        enrich.acknowledgement(config, as_of).alias("ack"),
    )


def under_registry(
    registry: Callable[[], DataFrame], config: IngestConfig = IngestConfig(), *, default: Contract = RAW_CONTRACT,
    as_of: Column | None = None,
) -> Callable[[DataFrame], DataFrame]:
    """``messages`` under the newest contract of the registry, looked up anew for every batch.

    ``registry`` opens the table of contracts (subject, version, schema). The bundled
    contract steps in if the table cannot be opened, has no entry for the
    subject, or its newest entry cannot be read. That last case is an error of whoever registered it and is
    reported: an audit message (SCHEMA_REGISTER, FAILURE) at the first record of each partition of the batch.
    """
    def transform(bodies: DataFrame) -> DataFrame:
        chosen = current_contract(registry, config.raw_subject, default)
        sent = messages(bodies, config, chosen.contract, as_of=as_of)
        if chosen.problem is None:
            return sent
        first = bodies.groupBy("topic", "partition").agg(F.min("offset").alias("offset"), F.min_by("timestamp", "offset").alias("recordTimestamp"))
        return sent.unionByName(route.fan_out(first, *route.audit_messages(
            audit.contract_records(chosen.problem, chosen.version, config, as_of=as_of), config)))
    return transform


@dataclass(frozen=True)
class Chosen:
    """The contract a batch is checked by; ``version`` and ``problem`` are of a newest entry that could not be read."""

    contract: Contract
    version: int | None = None
    problem: str | None = None


def current_contract(registry: Callable[[], DataFrame], subject: str, default: Contract = RAW_CONTRACT) -> Chosen:
    """The newest contract of the registry, or the bundled one and, if there is an entry that cannot be read, what is wrong with it."""
    try:
        newest = latest_versions(registry().filter(F.col("subject") == subject)).first()
    except PySparkException:
        # The table is not there.
        return Chosen(default)
    if newest is None:
        return Chosen(default)
    try:
        return Chosen(Contract.from_avro_json(newest["schema"] or ""))
    except UnreadableContract as error:
        return Chosen(default, newest["version"], str(error))
