from weirflow.session import settings


def test_partitions_follow_input_and_cores():
    assert settings(0.1, 8)["spark.sql.shuffle.partitions"] == "16"
    assert settings(100_000, 4000)["spark.sql.shuffle.partitions"] == "800000"
