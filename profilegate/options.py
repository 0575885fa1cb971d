"""Job options, checked once on the driver before any job starts."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from profilegate import schemas as S

_TOPIC = re.compile(r"[A-Za-z0-9._-]{1,249}")

# Producer settings the event log is written with; fixed values.
KAFKA_SINK_SETTINGS = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.retries": "10",
    "kafka.delivery.timeout.ms": "120000",
    "kafka.request.timeout.ms": "30000",
    "kafka.compression.type": "snappy",
}

SESSION_SETTINGS = {
    # Every timestamp rule is stated in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # The JVM never compiles methods above 8000 bytes. A stage with the whole rule set would be one;
    # with this limit Spark falls back to its split projections, which do get compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def check_topic(name: str) -> str:
    if name in {".", ".."} or not _TOPIC.fullmatch(name):
        raise ValueError(f"not a valid topic name: {name!r}")
    return name


@dataclass(frozen=True)
class JobOptions:
    created_topic: str = S.CREATED_TOPIC
    valid_topic: str = S.VALID_TOPIC
    invalid_topic: str = S.INVALID_TOPIC
    created_schema_id: int = 1
    invalid_schema_id: int = 2
    environment: str = "development"
    salt: str | None = field(default=None, repr=False)
    reference_date: dt.date | None = None
    watermark: str = "10 minutes"
    app_name: str = "profilegate"
    bootstrap_servers: tuple[str, ...] = ("localhost:9092",)
    sasl_username: str | None = None
    sasl_password: str | None = field(default=None, repr=False)
    max_offsets_per_trigger: int | None = None
    country_codes: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        topics = {check_topic(x) for x in (self.created_topic, self.valid_topic, self.invalid_topic)}
        if len(topics) < 3:
            raise ValueError("the topic that is read and those of valid and invalid events must be three")
        for name in ("salt", "sasl_username", "sasl_password"):
            if getattr(self, name) == "":
                object.__setattr__(self, name, None)
        if self.environment != "development" and self.salt is None:
            raise ValueError("a pseudonymization salt is required outside development")
        if (self.sasl_username is None) != (self.sasl_password is None):
            raise ValueError("SASL user name and password must be set together")
        if not self.bootstrap_servers or any(not s.strip() for s in self.bootstrap_servers):
            raise ValueError("bootstrap servers must not be blank")

    @property
    def today(self) -> dt.date:
        return self.reference_date or dt.datetime.now(tz=dt.UTC).date()

    @property
    def today_column(self) -> Column:
        """The pinned reference date, or the UTC date of each batch, which a long-running job needs."""
        return F.current_date() if self.reference_date is None else F.lit(self.reference_date)

    @property
    def iso_codes(self) -> tuple[str, ...]:
        return self.country_codes or S.iso_country_codes()

    def _kafka_connection(self) -> dict[str, str]:
        out = {"kafka.bootstrap.servers": ",".join(self.bootstrap_servers), "kafka.client.id": self.app_name}
        if self.sasl_username is not None:
            login = 'org.apache.kafka.common.security.plain.PlainLoginModule required username="%s" password="%s";'
            escape = lambda s: s.replace("\\", "\\\\").replace('"', '\\"')
            out |= {
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": login % (escape(self.sasl_username), escape(self.sasl_password)),
            }
        return out

    def kafka_sink(self) -> dict[str, str]:
        """Options for ``write(Stream).format("kafka")``; the topic travels in each row."""
        return self._kafka_connection() | KAFKA_SINK_SETTINGS

    def kafka_source(self, topics: tuple[str, ...] | None = None, starting: str = "earliest") -> dict[str, str]:
        """Options for ``readStream.format("kafka")``."""
        out = self._kafka_connection()
        topics = topics or (self.created_topic,)
        if {self.valid_topic, self.invalid_topic} & set(topics):
            raise ValueError("a topic this job writes to must not be read by it")
        # Correlation ids travel in the headers, which are left out by default.
        out |= {"subscribe": ",".join(topics), "startingOffsets": starting, "includeHeaders": "true"}
        if self.max_offsets_per_trigger is not None:
            out["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return out


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators rely on."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder all executors can reach, under ``spark.checkpoint.dir`` or the context's checkpoint folder."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base.rstrip('/')}/run-{uuid.uuid4().hex}"


def local_folder(spark: SparkSession) -> SparkSession:
    """Give a session on one machine a checkpoint folder if it has none, as tests and benchmarks do."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known is None and spark.sparkContext.master.partition("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="profilegate-"))
    return spark
