"""The JDBC sink's options, checked with a stand-in writer (no database is started)."""

from pitlane.sinks.files import write_jdbc


class FakeWriter:
    def __init__(self):
        self.calls = {"options": {}}

    def format(self, f):
        self.calls["format"] = f
        return self

    def option(self, k, v):
        self.calls["options"][k] = v
        return self

    def mode(self, m):
        self.calls["mode"] = m
        return self

    def save(self):
        self.calls["saved"] = True


class FakeFrame:
    def __init__(self):
        self.write = FakeWriter()


def test_jdbc_options_and_credentials_from_environment(monkeypatch):
    monkeypatch.setenv("PITLANE_JDBC_USER", "etl")
    monkeypatch.setenv("PITLANE_JDBC_PASSWORD", "from-env")
    df = FakeFrame()
    write_jdbc(df, "jdbc:postgresql://db/telemetry", "telemetry", num_partitions=16, properties={"driver": "org.postgresql.Driver"})
    c = df.write.calls
    assert c["format"] == "jdbc" and c["mode"] == "overwrite" and c["saved"]
    o = c["options"]
    assert o["url"] == "jdbc:postgresql://db/telemetry" and o["dbtable"] == "telemetry"
    assert o["numPartitions"] == 16 and o["batchsize"] == 10000 and o["truncate"] is False
    assert o["user"] == "etl" and o["password"] == "from-env" and o["driver"] == "org.postgresql.Driver"


def test_jdbc_explicit_credentials_win(monkeypatch):
    monkeypatch.setenv("PITLANE_JDBC_USER", "etl")
    df = FakeFrame()
    write_jdbc(df, "jdbc:x", "t", mode="append", truncate=True, properties={"user": "given"})
    o = df.write.calls["options"]
    assert o["user"] == "given" and o["truncate"] is True and "numPartitions" not in o
    assert df.write.calls["mode"] == "append"
