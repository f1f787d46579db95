import pytest

from tidemark.plans import jobs
from tidemark.plans.cli import build_parser, kafka_config, landing_job
from tidemark.plans.config import FlatLandingJob, LandingJob
from tidemark.schema import flat_schema
from tidemark.sinks.rolling import RollingPolicy
from tidemark.sources.kafka import KafkaConfig, KafkaSecurity, kafka_values, utf8_text


def test_read_options():
    options = KafkaConfig("b1:9092,b2:9092", "changes", group_id="g").read_options()
    assert options == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "changes",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "50000000",
    }
    options = KafkaConfig("b:1", "t", group_id_prefix="p", max_offsets_per_trigger=None).read_options()
    assert options["groupIdPrefix"] == "p" and not {"kafka.group.id", "maxOffsetsPerTrigger"} & options.keys()


def test_scaling_and_extra_options():
    options = KafkaConfig(
        "b:1",
        "t",
        starting_offsets="latest",
        max_records_per_partition=10**6,
        min_partitions=400,
        max_offsets_per_trigger=10**9,
        extra={"failOnDataLoss": "false"},
    ).read_options()
    assert options["startingOffsets"] == "latest"
    assert options["maxRecordsPerPartition"] == "1000000"
    assert options["minPartitions"] == "400"
    assert options["maxOffsetsPerTrigger"] == "1000000000"
    assert options["failOnDataLoss"] == "false"
    assert "kafka.group.id" not in options


def test_security_options():
    security = KafkaSecurity(truststore_location="/t.jks", truststore_password="secret")
    assert security.options() == {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "GSSAPI",
        "kafka.sasl.kerberos.service.name": "kafka",
        "kafka.ssl.truststore.location": "/t.jks",
        "kafka.ssl.truststore.password": "secret",
    }
    assert "secret" not in repr(KafkaConfig("b:1", "t", security=security))


def test_write_options():
    config = KafkaConfig("b:1", "t", group_id="g", security=KafkaSecurity(), extra={"x": "y"})
    options = config.write_options()
    assert options["topic"] == "t"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert not {"subscribe", "startingOffsets", "kafka.group.id", "x"} & options.keys()


@pytest.mark.parametrize("servers, topic", [("", "t"), ("b:1", ""), ("b:1", "a,b")])
def test_required_and_single_topic(servers, topic):
    with pytest.raises(ValueError):
        KafkaConfig(servers, topic)


def test_connector_is_asked_for(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_values(spark, KafkaConfig("localhost:1", "t"))


def test_bytes_to_text(spark):
    df = spark.createDataFrame(
        [(bytearray("gü".encode()),), (bytearray(b"a\xffb"),), (None,)], "value binary"
    )

    def run(policy):
        return [r[0] for r in df.select(utf8_text("value", policy)).collect()]

    assert run("replace") == ["gü", "a�b", None]
    assert run("null") == ["gü", None, None]
    kept = df.select(utf8_text("value", "keep").cast("binary")).collect()
    assert bytes(kept[1][0]) == b"a\xffb"
    with pytest.raises(ValueError):
        utf8_text("value", "other")


@pytest.mark.parametrize("own, record, used", [(None, 1024, "131072"), (5, 1024, "5"), (None, None, None)])
def test_a_task_reads_one_file_of_records(spark, monkeypatch, tmp_path, own, record, used):
    asked = []

    def values(session, config, invalid):
        assert invalid == "keep"
        asked.append(config)
        return session.createDataFrame([("x",)], "value string")

    monkeypatch.setattr(jobs, "kafka_values", values)
    config = KafkaConfig("b:1", "t", max_records_per_partition=own)
    policy = RollingPolicy(record_bytes=record)
    jobs.land_raw(spark, LandingJob(str(tmp_path / "out"), kafka=config, policy=policy, invalid="keep"))
    assert asked[0].read_options().get("maxRecordsPerPartition") == used


def parse(*argv):
    return build_parser().parse_args(argv)


REQUIRED = ("--kafka-bootstrap-servers", "b:1", "--kafka-topic", "t", "--output-path", "/out")


@pytest.mark.parametrize(
    "job, group, offsets, secured",
    [
        ("raw", "flink-group", "earliest", True),
        ("filtered", "flink-cdp-json", "latest", True),
        ("flat", "flink-kafka-group", "earliest", False),
    ],
)
def test_job_defaults(job, group, offsets, secured):
    config = kafka_config(parse(job, *REQUIRED), {})
    assert config.group_id is None
    assert config.read_options()["groupIdPrefix"] == group
    assert config.starting_offsets == offsets
    assert (config.security is not None) == secured


def test_dotted_parameter_names():
    arguments = parse(
        "filtered",
        "--kafka.bootstrap.servers=b:1",
        "--kafka.topic=t",
        "--hdfs.output.path=hdfs:///out/",
        "--kafka.group.id=mine",
    )
    job = landing_job(arguments, {})
    assert job.output_path == "hdfs:///out/"
    assert job.kafka.group_id == "mine"
    assert job.control("x").checkpoint == "hdfs:///out_checkpoint"


def test_sizes_and_job_settings_are_flags():
    sizes = ("--max-part-bytes", "1000", "--record-bytes", "10", "--rebalance", "--invalid-bytes", "null")
    job = landing_job(parse("flat", *REQUIRED, *sizes, "--key-prefix", "k", "--key-count", "3"), {})
    assert job.policy == RollingPolicy(max_part_bytes=1000, record_bytes=10, rebalance=True)
    assert (job.key_prefix, job.key_count, job.invalid) == ("k", 3, "null")
    assert parse("filtered", *REQUIRED, "--keys", "a", "b").keys == ["a", "b"]
    assert parse("raw", *REQUIRED).max_offsets_per_trigger == 50_000_000


@pytest.mark.parametrize("argv", [(), ("--kafka-topic", "t", "--output-path", "/o")])
def test_the_generator_has_one_target(argv, capsys):
    with pytest.raises(SystemExit):
        parse("generate", *argv)


def test_secrets_come_from_settings():
    settings = {"spark.tidemark.ssl.key.password": "secret"}
    config = kafka_config(parse("raw", *REQUIRED, "--kerberos-service-name", "broker"), settings)
    assert config.read_options()["kafka.ssl.key.password"] == "secret"
    assert config.read_options()["kafka.sasl.kerberos.service.name"] == "broker"


@pytest.mark.parametrize("left_out", [0, 2, 4])
def test_missing_required_parameter(left_out, capsys):
    argv = REQUIRED[:left_out] + REQUIRED[left_out + 2 :]
    with pytest.raises(SystemExit):
        parse("raw", *argv)


def test_job_objects():
    with pytest.raises(ValueError):
        LandingJob("")
    flat = FlatLandingJob("/out")
    assert flat.policy.record_bytes is None
    assert flat.key_count + 11 == len(flat_schema().fields)
