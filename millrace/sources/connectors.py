"""Option sets for external systems; the connector jars come with the cluster."""

from __future__ import annotations

from urllib.parse import urlparse

DEFAULT_TOPIC = "raw_orders"


def kafka_security(
    protocol: str = "PLAINTEXT",
    mechanism: str = "PLAIN",
    username: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    """Kafka client security options; none for a plain-text broker."""
    if not protocol or protocol.upper() == "PLAINTEXT":
        return {}
    options = {"kafka.security.protocol": protocol.upper()}
    if protocol.upper().startswith("SASL"):
        options["kafka.sasl.mechanism"] = mechanism
        if username and password:
            module = "scram.ScramLoginModule" if mechanism.startswith("SCRAM") else "plain.PlainLoginModule"
            login = f"org.apache.kafka.common.security.{module}"
            options["kafka.sasl.jaas.config"] = f'{login} required username="{username}" password="{password}";'
    return options


def kafka_source(
    servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    **security: str,
) -> dict[str, str]:
    """Options for reading order events from a topic."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **kafka_security(**security),
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_sink(servers: str, topic: str = DEFAULT_TOPIC, **security: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **kafka_security(**security)}


def jdbc_url(
    database_url: str | None = None,
    host: str = "localhost",
    port: int = 5432,
    database: str = "warehouse",
) -> str:
    """A PostgreSQL JDBC address from a connection URI, or from its parts."""
    if database_url:
        scheme, _, rest = database_url.partition("://")
        parsed = urlparse(f"postgresql://{rest}" if scheme else database_url)
        host = parsed.hostname or host
        port = parsed.port or port
        database = parsed.path.lstrip("/") or database
    return f"jdbc:postgresql://{host}:{port}/{database}"


def jdbc_table(
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options for a JDBC table; give a partition column and bounds to read it in parallel."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": "org.postgresql.Driver"}
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return options
