"""Operators whose results SQL can't show, sources and sinks, streams."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from rillflow.functions import ip as ips
from rillflow.operators import alerts, anonymize, features, joins, project, records, segments, setops, timeseries, topn
from rillflow.operators.aggregate import Agg, aggregated, biflows
from rillflow.plans.flows import flows
from rillflow.schema import parse_template, struct, template_of
from rillflow.sources import readers, writers
from rillflow.streaming import queries as live

KEY = b"0123456789abcdef"


def test_templates():
    fields = parse_template('ipaddr A,uint8 B=3,string C="x,y",int32* D')
    assert [(f.name, f.kind, f.array, f.default) for f in fields] == [("A", "ipaddr", False, None), ("B", "uint8", False, "3"), ("C", "string", False, '"x,y"'), ("D", "int32", True, None)]
    assert struct(fields).fieldNames() == ["A", "B", "C", "D"]
    for bad in ("nothing A", "uint8", "uint8 A,uint8 A", "uint8 1A"):
        with pytest.raises(ValueError):
            parse_template(bad)


def test_anonymized_addresses_share_prefixes():
    def common(a, b):
        x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        return 8 * len(a) - x.bit_length()

    texts = ["10.0.0.1", "10.0.0.2", "10.0.128.1", "10.128.0.1", "192.168.0.1", "2001:db8::1", "2001:db8::2", "2001:db8:8000::1"]
    for a in texts:
        x = ips.packed(a)
        assert anonymize.anonymized_bytes(anonymize.anonymized_bytes(x, KEY), KEY, reverse=True) == x
        for b in texts:
            y = ips.packed(b)
            if len(x) == len(y):
                assert common(x, y) == common(anonymize.anonymized_bytes(x, KEY), anonymize.anonymized_bytes(y, KEY))
    said = "from 10.0.0.1 to ::1"
    hidden = anonymize.anonymized_text(said, KEY)
    assert hidden != said and hidden.endswith(" to ::1") and anonymize.anonymized_text(hidden, KEY, reverse=True) == said


def test_csv_lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text('time,ipaddr SRC_IP,uint16 PORT,string NAME,uint32* L\n1,10.0.0.1,53,"a ""b"", c",[1|2]\n2,bad,53,x,[]\n3,::1,80,,[7]\n4,10.0.0.2,x,y,[]\n')
    df = readers.read_csv(spark, str(tmp_path / "in.csv"))
    got = sorted((ips_text, r["PORT"], r["NAME"], r["L"]) for r in df.withColumn("t", ips.text(F.col("SRC_IP"))).collect() for ips_text in [r["t"]])
    assert got == [("10.0.0.1", 53, 'a "b", c', [1, 2]), ("::1", 80, "", [7])]
    assert template_of(df) == "ipaddr SRC_IP,uint16 PORT,string NAME,uint32* L"
    writers.write_csv(df, str(tmp_path / "out"), title=True, delimiter=r"\t")
    assert spark.read.text(str(tmp_path / "out" / "_template")).first()[0] == template_of(df)
    with pytest.raises(ValueError):
        writers.write_csv(df, str(tmp_path / "bad"), delimiter="ab")


def test_rules_and_limits():
    rules = timeseries.parsed_rules(r"a:sum(BYTES):NAME == \"x\:y\",b:COUNT()".replace('\\"', '"'))
    assert [(r.name, r.function, r.field, r.condition) for r in rules] == [("a", "SUM", "BYTES", 'NAME == "x:y"'), ("b", "COUNT", "", "")]
    for bad in ("a:NO(B)", "1:SUM(B)", "a:SUM()", "a:SUM(B),a:SUM(B)"):
        with pytest.raises(ValueError):
            timeseries.parsed_rules(bad)


def test_missing_fields_are_zero(spark):
    one, two = spark.range(2).select(F.col("id").alias("A")), spark.range(3).select(F.lit("x").alias("B"))
    assert sorted(map(tuple, setops.merged([one, two]).collect())) == [(0, ""), (0, "x"), (0, "x"), (0, "x"), (1, "")]
    with pytest.raises(ValueError):
        setops.merged([])
    out = project.projected(one, "int64 A,ipaddr IP,time T").collect()
    assert bytes(out[0]["IP"]) == bytes(16) and out[0]["T"].year == 1970


def test_routes(spark, sf_dir):
    parts = project.routed(flows(spark, sf_dir), "uint64 BYTES:DST_PORT == 53;:DST_PORT == 80")
    assert parts[0].columns == ["BYTES"] and "SRC_IP" in parts[1].columns


def test_pairs_are_one_to_one(spark):
    schema = "seq long, SRC_IP string, DST_IP string, SRC_PORT int, DST_PORT int, PROTOCOL int, first long, last long"

    def side(rows):
        df = spark.createDataFrame(rows, schema)
        stamp = lambda c: F.timestamp_millis(c).cast("timestamp_ntz").alias
        return df.select("seq", ips.parse(F.col("SRC_IP")).alias("SRC_IP"), ips.parse(F.col("DST_IP")).alias("DST_IP"), "SRC_PORT", "DST_PORT", "PROTOCOL", stamp("first")("TIME_FIRST"), stamp("last")("TIME_LAST"))

    lan = side([(1, "10.0.0.1", "8.8.8.8", 5, 53, 17, 1000, 1001), (2, "10.0.0.2", "8.8.8.8", 6, 53, 17, 1000, 1001), (3, "8.8.8.8", "10.0.0.1", 53, 5, 17, 2001, 2002), (4, "10.0.0.1", "10.0.0.2", 1, 1, 6, 1, 1)])
    wan = side([(11, "147.1.1.1", "8.8.8.8", 5, 53, 17, 1001, 1002), (12, "8.8.8.8", "147.1.1.1", 53, 5, 17, 2000, 2001), (13, "147.1.1.1", "9.9.9.9", 5, 53, 17, 1001, 1002)])
    assert sorted(map(tuple, joins.nat_pairs(lan, wan, "147.1.1.1").collect())) == [(1, 11), (3, 12)]


def test_alert_documents(spark, sf_dir):
    df = flows(spark, sf_dir).limit(5).withColumn("EVENT_SCALE", F.col("PACKETS"))
    for r in alerts.document(alerts.miner(df)).collect():
        doc = json.loads(r["value"])
        assert doc["Category"] == ["Suspicious.Miner"] and "CreateTime" in doc and len(doc["ID"]) == 36
        assert ("IP4" in doc["Source"][0]) != ("IP6" in doc["Source"][0])
    code = records.converted(df.select("seq"), lambda r: {"a": int(r["seq"])} if r["seq"] % 2 else None)
    assert all("a" in json.loads(r["value"]) for r in code.collect())


def test_top_lists_have_all_ties_ordered(spark):
    df = spark.createDataFrame([(i, 1, 2, 5, 10) for i in range(20)], "seq long, SRC_PORT int, DST_PORT int, PACKETS long, BYTES long")
    assert [r["seq"] for r in topn.top_flows(df, 3).orderBy("rank").collect()] == [0, 1, 2]


def test_streams_give_what_batches_give(spark, sf_dir, tmp_path):
    df = flows(spark, sf_dir).withColumn("TIME_FIRST", F.col("TIME_FIRST")).select("seq", "DST_PORT", "PACKETS", "BYTES", "TIME_FIRST", "TIME_LAST")
    path = str(tmp_path / "in")
    df.repartition(3).write.parquet(path)
    stream = live.receive(spark, path, df.schema, "uint64 BYTES")
    aggs = [Agg("SUM", "BYTES"), Agg("MAX", "PACKETS")]
    out = live.drained(live.windowed(stream, ["DST_PORT"], aggs, "30 days", "4000 days"), "w", str(tmp_path / "c1"), "complete")
    total = out.agg(F.sum("COUNT"), F.sum("BYTES"), F.max("PACKETS")).first()
    assert tuple(total) == tuple(df.agg(F.count("*"), F.sum("BYTES"), F.max("PACKETS")).first())
    ended = live.drained(live.active_timeout(live.receive(spark, path, df.schema), ["DST_PORT"], 10**9, 10**9), "a", str(tmp_path / "c2"))
    assert ended.columns == ["DST_PORT", "COUNT", "PACKETS", "BYTES", "FIRST_US", "LAST_US"]
    kept = live.drained(live.receive(spark, path, df.schema).where("DST_PORT = 53").select("seq"), "f", str(tmp_path / "c3"))
    assert kept.count() == df.where("DST_PORT = 53").count()
    assert aggregated(df, ["DST_PORT"], aggs).count() == 7


def test_lists_of_a_group_are_bounded_and_in_order(spark):
    rows = [(1, i, "abcdefgh"[: i % 4], [i, i + 1][: i % 3], [9 - i % 5, i % 5][: i % 3]) for i in range(200)] + [(2, 5, "", [], [])]
    df = spark.createDataFrame(rows, "K long, seq long, S string, V array<long>, O array<long>")
    aggs = [Agg("APPEND", "S", size=17, delimiter=":"), Agg("APPEND", "V", size=9), Agg("SORTED_MERGE", "V", "M", key="O", size=7)]
    whole = [Agg("APPEND", "V", "W"), Agg("SORTED_MERGE", "V", "X", key="O", descending=True)]
    got = {r["K"]: r for r in aggregated(df, ["K"], [*aggs, *whole]).collect()}
    text, flat, merged = "", [], []
    for _, i, s, v, o in rows[:200]:
        if len(text) + len(s) + 1 <= 17:
            text += s + ":"
        flat += v
        merged += [(k, i, j, x) for j, (k, x) in enumerate(zip(o, v, strict=True))]
    assert (got[1]["S"], got[1]["V"], got[1]["W"]) == (text, flat[:9], flat)
    assert got[1]["M"] == [x[3] for x in sorted(merged)][:7]
    assert got[1]["X"] == [x[3] for x in sorted(merged, key=lambda x: (-x[0], *x[1:3]))]
    assert (got[2]["S"], got[2]["V"], got[2]["M"], got[2]["COUNT"]) == (":", [], [], 1)
    alone = aggregated(df, [], aggs).first()
    assert len(alone["S"]) <= 17 and alone["V"] == flat[:9]
    plan = aggregated(df, ["K"], [aggs[1]])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_direction_of_merged_values(spark):
    stamp = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    schema = "seq long, SRC_IP string, DST_IP string, SRC_PORT int, DST_PORT int, PROTOCOL int, t long, D array<int>, K array<int>"
    rows = [(1, "10.0.0.1", "10.0.0.2", 5, 6, 6, 10, [5, 6], [1, 2]), (2, "10.0.0.2", "10.0.0.1", 6, 5, 6, 11, [7], [3])]
    for lead, expected in ((0, [5, 6, -7]), (5, [-5, -6, 7])):
        df = spark.createDataFrame([rows[0], (*rows[1][:6], 11 - lead, *rows[1][7:])], schema)
        df = df.select("seq", ips.parse(F.col("SRC_IP")).alias("SRC_IP"), ips.parse(F.col("DST_IP")).alias("DST_IP"), "SRC_PORT", "DST_PORT", "PROTOCOL", stamp("t").alias("TIME_FIRST"), stamp("t").alias("TIME_LAST"), "D", "K")
        for size in (0, 9):
            out = biflows(df, [Agg("SORTED_MERGE_DIR", "D", key="K", size=size)]).first()
            assert out["D"] == expected and out["SRC_PORT"] == (6 if lead else 5)


def test_clock_with_resets_is_the_same_in_slices(spark, monkeypatch):
    r = random.Random(6)
    t, rows = 1000, []
    for i in range(600):
        t += r.randint(0, 20)
        if r.random() < 0.02:
            t += r.choice([-900, 700])
        rows.append((i, t + r.choice([0, 0, 0, 50, -80])))
    df = spark.createDataFrame(rows, "seq long, t long").withColumn("TIME_LAST", F.timestamp_seconds("t").cast("timestamp_ntz"))
    clock, skipped, epoch, expected = None, 0, 0, []
    for i, t in rows:
        if clock is not None and not clock - 60 <= t <= clock + 30:
            skipped += 1
            if skipped >= 3:
                clock, skipped, epoch = t, 0, epoch + 1
            continue
        skipped, clock = 0, t if clock is None else max(clock, t)
        expected.append((i, epoch))
    assert epoch > 1
    for size in (10**6, 50, 7):
        monkeypatch.setattr(segments, "IN_TIME_RECORDS", size)
        got = segments.in_time(df, 60, 30, 3).select("seq", "epoch").orderBy("seq").collect()
        assert [tuple(x) for x in got] == expected


def test_unfinished_pairs_wait_by_side(spark):
    """One to one in order of arrival, against a plain scan of all that wait."""
    r = random.Random(2)
    schema = "seq long, SRC_IP string, DST_IP string, SRC_PORT int, DST_PORT int, PROTOCOL int, first long, last long"

    def side(rows):
        df = spark.createDataFrame(rows, schema)
        stamp = lambda c: F.timestamp_millis(c).cast("timestamp_ntz")
        return df.select("seq", ips.parse(F.col("SRC_IP")).alias("SRC_IP"), ips.parse(F.col("DST_IP")).alias("DST_IP"), "SRC_PORT", "DST_PORT", "PROTOCOL", stamp("first").alias("TIME_FIRST"), stamp("last").alias("TIME_LAST"))

    lan, wan = [], []
    for i in range(300):
        at = 1000 + i // 3
        (lan if r.random() < 0.5 else wan).append((i, "", "8.8.8.8", 5, 53, 17, at, at + r.randint(0, 3)))
    lan, wan = [(*x[:1], "10.0.0.1", *x[2:]) for x in lan], [(*x[:1], "147.1.1.1", *x[2:]) for x in wan]
    waiting, expected = [], []
    for first, i, s, last in sorted([(x[6], x[0], "lan", x[7]) for x in lan] + [(x[6], x[0], "wan", x[7]) for x in wan]):
        waiting = [w for w in waiting if first - w[0] < 2]
        for w in waiting:
            inner, outer = ((first, last), (w[0], w[3])) if s == "lan" else ((w[0], w[3]), (first, last))
            if w[2] != s and 0 <= outer[0] - inner[0] < 2 and 0 <= outer[1] - inner[1] < 3:
                waiting.remove(w)
                expected.append((i, w[1]) if s == "lan" else (w[1], i))
                break
        else:
            waiting.append((first, i, s, last))
    assert sorted(map(tuple, joins.nat_pairs(side(lan), side(wan), "147.1.1.1").collect())) == sorted(expected) and expected


def test_addresses_as_text(spark):
    r = random.Random(3)
    raw = [bytes(r.choice([0, 0, 0, 1, 16, 255]) for _ in range(16)) for _ in range(400)] + [bytes(16), bytes(15) + b"\1", b"\1" + bytes(15), b"\0\1" * 8, bytes([10, 0, 0, 255])]
    df = spark.createDataFrame([(i, bytearray(x)) for i, x in enumerate(raw)], "i long, x binary")

    def plain(x):
        groups = [f"{x[k] * 256 + x[k + 1]:x}" for k in range(0, 16, 2)]
        best = (0, 0)
        for i in range(8):
            n = 0
            while i + n < 8 and groups[i + n] == "0":
                n += 1
            best = max(best, (n, -i))
        if best[0] < 2:
            return ":".join(groups)
        i = -best[1]
        return ":".join(groups[:i]) + "::" + ":".join(groups[i + best[0] :])

    got = {x["i"]: x["t"] for x in df.select("i", ips.text(F.col("x")).alias("t")).collect()}
    assert [got[i] for i in range(len(raw) - 1)] == [plain(x) for x in raw[:-1]] and got[len(raw) - 1] == "10.0.0.255"


def test_sessions_series_and_joins_on_streams(spark, tmp_path):
    stamp = lambda c: F.timestamp_seconds(c)
    rows = [(i, 53 if i % 2 else 80, 1, 10 + i, 1000 + 7 * i + (500 if i > 30 else 0), 1003 + 7 * i + (500 if i > 30 else 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "seq long, DST_PORT int, PACKETS long, BYTES long, a long, z long")
    df = df.select("seq", "DST_PORT", "PACKETS", "BYTES", stamp("a").alias("TIME_FIRST"), stamp("z").alias("TIME_LAST"))
    path = str(tmp_path / "in")
    df.coalesce(1).write.parquet(path)
    stream = lambda: live.receive(spark, path, df.schema)
    out = live.drained(live.sessions(stream(), ["DST_PORT"], [Agg("SUM", "BYTES")], "60 seconds", "10000 seconds"), "s", str(tmp_path / "c1"), "complete")
    islands = sorted((p, sum(1 for r in rows if r[1] == p and (r[0] > 30) == late), sum(r[3] for r in rows if r[1] == p and (r[0] > 30) == late)) for p in (53, 80) for late in (False, True))
    assert sorted((r["DST_PORT"], r["COUNT"], r["BYTES"]) for r in out.collect()) == islands
    rules = timeseries.parsed_rules("n:COUNT(),total:SUM(BYTES)")
    steps = live.drained(live.series(stream(), rules, 60, "10000 seconds"), "t", str(tmp_path / "c2"), "complete").groupBy("TIME").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    batch = timeseries.series(df, rules, 60)
    assert sorted((r["TIME"], r["n"], round(r["total"], 6)) for r in steps.collect()) == sorted((r["TIME"], r["n"], round(r["total"], 6)) for r in batch.collect())
    seen = []
    q = live.for_each(stream(), lambda b, k: seen.append(b.count()), str(tmp_path / "c3"))
    q.awaitTermination()
    assert sum(seen) == 60 and sum(p["rows"] for p in live.progress(q)) == 60
    (tmp_path / "filters").write_text("uint64 BYTES:DST_PORT == 53; :DST_PORT == 80 and BYTES > 20")
    counts = []
    live.reloading(stream(), f"file://{tmp_path}/filters", lambda b, k: counts.extend(tuple(x) for x in b.groupBy("out_id").count().collect()), str(tmp_path / "c4")).awaitTermination()
    assert dict(counts) == {0: 30, 1: sum(1 for r in rows if r[1] == 80 and r[3] > 20)}
    files = str(tmp_path / "many")
    df.repartition(3).write.parquet(files)
    texts, kept = ["uint64 BYTES:DST_PORT == 53", ":BROKEN ((", ":true"], []

    def act(batch, k):
        kept.append(batch.count())
        (tmp_path / "filters").write_text(texts[min(k + 1, 2)])

    (tmp_path / "filters").write_text(texts[0])
    one_by_one = live.receive(spark, files, df.schema, files_per_trigger=1)
    live.reloading(one_by_one, f"file://{tmp_path}/filters", act, str(tmp_path / "c5")).awaitTermination()
    assert len(kept) == 3 and kept[0] < 20 and kept[1] < 20 and kept[2] >= 15


def test_pairs_and_replies_on_streams(spark, tmp_path):
    schema = "seq long, SRC_IP string, DST_IP string, SRC_PORT int, DST_PORT int, PROTOCOL int, TCP_FLAGS int, first long, last long"

    def side(rows, name):
        df = spark.createDataFrame(rows, schema)
        df = df.select("seq", ips.parse(F.col("SRC_IP")).alias("SRC_IP"), ips.parse(F.col("DST_IP")).alias("DST_IP"), "SRC_PORT", "DST_PORT", "PROTOCOL", "TCP_FLAGS", F.timestamp_millis("first").alias("TIME_FIRST"), F.timestamp_millis("last").alias("TIME_LAST"))
        df.coalesce(1).write.parquet(str(tmp_path / name))
        return live.receive(spark, str(tmp_path / name), df.schema)

    lan = side([(1, "10.0.0.1", "8.8.8.8", 5, 53, 17, 0, 1000, 1001), (2, "10.0.0.2", "8.8.8.8", 6, 53, 17, 0, 9000, 9001)], "lan")
    wan = side([(11, "147.1.1.1", "8.8.8.8", 5, 53, 17, 0, 1001, 1002), (13, "147.1.1.1", "9.9.9.9", 5, 53, 17, 0, 1001, 1002)], "wan")
    assert [tuple(r) for r in live.drained(live.paired(lan, wan, "147.1.1.1"), "p", str(tmp_path / "c1")).collect()] == [(1, 11)]
    rows = [(1, "10.0.0.1", "8.8.8.8", 5, 80, 6, 2, 1000, 2000), (2, "8.8.8.8", "10.0.0.1", 80, 5, 6, 18, 3000, 4000), (3, "9.9.9.9", "10.0.0.1", 80, 5, 6, 18, 3000, 4000), (4, "7.7.7.7", "10.0.0.9", 80, 5, 17, 0, 10**7, 10**7)]
    got = live.drained(live.one_way(side(rows, "r")), "o", str(tmp_path / "c2"))
    assert [r["seq"] for r in got.collect()] == [3]


def test_lines_and_mails_are_sent(spark):
    import socket
    import threading

    def served(talk):
        server = socket.create_server(("127.0.0.1", 0))
        server.settimeout(30)
        heard = []

        def run():
            while True:
                try:
                    link, _ = server.accept()
                except OSError:
                    return
                talk(link, heard)

        threading.Thread(target=run, daemon=True).start()
        return server, heard

    def lines(link, heard):
        heard.extend(link.makefile("rb").read().decode().splitlines())

    def mail(link, heard):
        f = link.makefile("rwb")
        say = lambda x: (f.write(x + b"\r\n"), f.flush())
        say(b"220 here")
        body = None
        for raw in f:
            line = raw.rstrip(b"\r\n")
            if body is not None:
                if line == b".":
                    heard.append(b"\n".join(body).decode())
                    body = None
                    say(b"250 ok")
                else:
                    body.append(line)
            elif line.upper() == b"DATA":
                body = []
                say(b"354 go on")
            else:
                say(b"221 bye" if line.upper() == b"QUIT" else b"250 ok")
                if line.upper() == b"QUIT":
                    return

    server, heard = served(lines)
    writers.send_lines(spark.createDataFrame([("a",), ("b",)], "value string").coalesce(1), "127.0.0.1", server.getsockname()[1])
    mails, letters = served(mail)
    writers.send_mails(spark.createDataFrame([("one",), ("two",)], "mail string").coalesce(1), "127.0.0.1", mails.getsockname()[1], "a@example.org", "b@example.org", "Alert")
    for _ in range(100):
        if len(heard) == 2:
            break
        time.sleep(0.1)
    assert heard == ["a", "b"] and len(letters) == 2 and "Subject: Alert" in letters[0] and letters[1].endswith("two")


def test_peers_are_uploaded(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    heard = {}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = b""
            while n := int(self.rfile.readline(), 16):
                body += self.rfile.read(n)
                self.rfile.readline()
            self.rfile.readline()
            heard[self.path] = body.decode().split()
            self.send_response(200)
            self.end_headers()

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = [(10, 1, "10.0.0.1"), (11, 1, "10.0.0.1"), (12, 1, "2001:db8::1"), (310, 1, "10.0.0.2"), (13, 2, "10.0.0.3"), (14, 9, "10.0.0.4")]
    df = spark.createDataFrame(rows, "t long, PREFIX_TAG int, d string").select(F.timestamp_seconds("t").cast("timestamp_ntz").alias("TIME_LAST"), "PREFIX_TAG", ips.parse(F.col("d")).alias("DST_IP"))
    writers.upload_peers(writers.peer_sets(df, {1: "one", 2: "two"}), "127.0.0.1", server.server_port, "/filters")
    server.shutdown()
    assert heard == {"/filters/one/0/300/": ["10.0.0.1", "2001:db8::1"], "/filters/one/300/600/": ["10.0.0.2"], "/filters/two/0/300/": ["10.0.0.3"]}


def test_times_by_rule_messages_and_models(spark, tmp_path):
    (tmp_path / "m").write_text('{"a": 1}\n\nbroken{\n{"b": "x"}\n')
    assert readers.read_messages(spark, str(tmp_path / "m")).count() == 2
    base = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    out = spark.range(1).select(readers.shifted_time(base, "+90").alias("a"), readers.shifted_time(base, "-0.5").alias("b"), readers.shifted_time(base, "now+0").alias("c")).first()
    assert (str(out["a"]), str(out["b"])) == ("2020-01-01 00:01:30", "2019-12-31 23:59:59.500000") and out["c"].year > 2020
    r = random.Random(1)
    points = [(x, y, int(2 * x - y > 5)) for x, y in ((r.uniform(0, 10), r.uniform(0, 10)) for _ in range(300))]
    df = spark.createDataFrame(points, "x double, y double, up int")
    features.write_models(spark, features.fit_labels(df, ["x", "y"], ["up"]), f"file://{tmp_path}/models")
    held = spark.createDataFrame([(r.uniform(0, 10), r.uniform(0, 10)) for _ in range(300)], "x double, y double").withColumn("up", (2 * F.col("x") - F.col("y") > 5).cast("int"))
    with pytest.warns(UserWarning):
        models = features.read_models(spark, ["up", "none"], f"file://{tmp_path}/models")
    assert list(models) == ["up"] and features.labelled(held, models).where("up = is_up").count() > 270
    assert features.sparse_rows(spark.createDataFrame([(1, 0.0, 2.5)], "label int, a double, b double"), ["a", "b"]).first()[0] == "1 2:2.5"


def test_rate_limit_over_silences(spark):
    r = random.Random(9)
    t, rows = 0, []
    for i in range(400):
        t += r.choice([5, 60, 600, 9000]) if r.random() < 0.9 else -300
        rows.append((i, t))
    df = spark.createDataFrame(rows, "seq long, t long").withColumn("TIME_LAST", F.timestamp_seconds("t").cast("timestamp_ntz"))
    sent, expected = [], []
    for i, t in rows:
        if len(sent) < 3 or t - sent[-3] >= 3600:
            sent.append(t)
            expected.append(i)
    assert [x["seq"] for x in writers.limited_per_hour(df, 3).orderBy("seq").collect()] == expected
