"""Sinks for records and alerts: CSV, JSON, text reports, passive DNS, mail texts, rules with actions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..functions.scalar import array_text, seconds, tcp_flags_text
from ..plans import filters
from ..schema import kinds, template_of

_SEPARATORS = {r"\t": "\t", r"\f": "\f", r"\n": "\n", r"\r": "\r", r"\v": "\v"}


def as_text(column: Column, kind: str) -> Column:
    """A value as it stands in CSV."""
    if kind.endswith("*"):
        inner = F.transform(column, lambda x: as_text(x, kind[:-1]))
        return array_text(inner)
    if kind == "ipaddr":
        return ips.text(column)
    if kind == "macaddr":
        return ips.mac_text(column)
    if kind == "time":
        return F.date_format(column.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if kind == "bytes":
        return F.lower(F.hex(column))
    return column.cast("string")


def csv_rows(df: DataFrame, received: bool = False) -> DataFrame:
    """All fields as text, with the receive time in front if asked for."""
    columns = [as_text(F.col(n), k).alias(n) for n, k in kinds(df).items()]
    if received:
        columns.insert(0, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("time"))
    return df.select(*columns)


def write_csv(df: DataFrame, path: str, append: bool = False, title: bool = False, received: bool = False, limit: int | None = None, delimiter: str = ",") -> None:
    """Write records; ``title`` makes the template the first line, ``limit`` 0 writes only that."""
    separator = _SEPARATORS.get(delimiter, delimiter)
    if len(separator) != 1:
        raise ValueError("the delimiter must be one character")
    head = ("time," if received else "") + template_of(df)
    rows = csv_rows(df if limit is None else df.limit(limit), received)
    writer = rows.write.mode("append" if append else "overwrite").option("sep", separator).option("quote", '"').option("escape", '"')
    writer.csv(path)
    if title:
        df.sparkSession.createDataFrame([(head,)], "value string").coalesce(1).write.mode("append").text(f"{path}/_template")


def report_lines(df: DataFrame, longest_address: int | None = None) -> DataFrame:
    """Flows as fixed text lines: times, protocol name, addresses with ports, flag letters, packets, bytes."""
    proto = F.when(F.col("PROTOCOL") == 6, "TCP").when(F.col("PROTOCOL") == 17, "UDP").when(F.col("PROTOCOL") == 1, "ICMP").otherwise(F.col("PROTOCOL").cast("string"))
    rows = df.withColumn("_s", ips.text(F.col("SRC_IP"))).withColumn("_d", ips.text(F.col("DST_IP")))
    if longest_address is not None:
        rows = rows.where((F.length("_s") < longest_address) & (F.length("_d") < longest_address))
    span = F.round(seconds(F.col("TIME_LAST")) - seconds(F.col("TIME_FIRST")), 3)
    return rows.select(F.concat_ws(" ", as_text(F.col("TIME_FIRST"), "time"), F.format_string("%.3f", span), proto, F.concat("_s", F.lit(":"), F.col("SRC_PORT").cast("string")), F.lit("->"), F.concat("_d", F.lit(":"), F.col("DST_PORT").cast("string")), tcp_flags_text(F.col("TCP_FLAGS").cast("int")), F.col("PACKETS").cast("string"), F.col("BYTES").cast("string")).alias("value"))


def json_rows(df: DataFrame, match: dict[str, dict[str, str]] | None = None, regex: dict[str, list[tuple[str, str]]] | None = None, timify: tuple[str, ...] = ()) -> DataFrame:
    """Records as JSON: addresses as text, times as seconds; fields mapped by dictionary, by pattern or to time text.

    A value without an entry in a dictionary is null. Patterns are anchored at
    the start; of several that match, the last holds.
    """
    columns: dict[str, Column] = {}
    for name, kind in kinds(df).items():
        c = F.col(name)
        columns[name] = ips.text(c) if kind == "ipaddr" else ips.mac_text(c) if kind == "macaddr" else seconds(c) if kind == "time" else c
    for name, entries in (match or {}).items():
        pairs = [F.lit(x) for item in entries.items() for x in item]
        columns[name] = F.create_map(*pairs)[columns[name].cast("string")]
    for name, rules in (regex or {}).items():
        out, text = columns[name].cast("string"), columns[name].cast("string")
        for pattern, value in rules:
            out = F.when(text.rlike(f"^(?:{pattern})"), value).otherwise(out)
        columns[name] = out
    for name in timify:
        columns[name] = F.date_format(F.timestamp_micros((columns[name] * 1e6).cast("long")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return df.select(F.to_json(F.struct(*[c.alias(n) for n, c in columns.items()])).alias("value"))


def write_json(rows: DataFrame, path: str, append: bool = False) -> None:
    """Write JSON texts (column ``value``); texts that are no JSON are skipped."""
    rows.where(F.try_parse_json("value").isNotNull()).select("value").write.mode("append" if append else "overwrite").text(path)


#: Answer types of passive DNS.
DNS_TYPES = {1: "A", 5: "CNAME", 28: "AAAA"}


def passive_dns(df: DataFrame) -> DataFrame:
    """Single-packet answers without error: response, query, ttl, type, times. Address answers must be addresses."""
    kind = F.col("DNS_QTYPE")
    good = (F.col("PACKETS") == 1) & (F.col("DNS_ANSWERS") >= 1) & (F.col("SRC_PORT") == 53) & (F.col("DNS_RCODE") == 0) & kind.isin(*DNS_TYPES)
    address = kind.isin(1, 28)
    rows = df.where(good & (~address | ips.parse(F.col("DNS_RDATA")).isNotNull()))
    name = F.create_map(*[F.lit(x) for item in DNS_TYPES.items() for x in item])[kind.cast("int")]
    return rows.select(F.col("DNS_RDATA").alias("response"), F.col("DNS_NAME").alias("query"), F.col("DNS_RR_TTL").alias("ttl"), name.alias("type"), as_text(F.col("TIME_FIRST"), "time").alias("time_first"), as_text(F.col("TIME_LAST"), "time").alias("time_last"))


def write_passive_dns(df: DataFrame, path: str, per_file: int = 5000) -> None:
    passive_dns(df).write.mode("append").option("maxRecordsPerFile", per_file).option("compression", "gzip").json(path)


def mail_texts(df: DataFrame, template: str) -> DataFrame:
    """A text for each record: ``$FIELD`` is the field's value, the longest name first; ``$_DATETIME_`` is now."""
    types = kinds(df)
    names = sorted(types, key=len, reverse=True)
    parts: list[Column] = []
    for piece in re.split(r"(\$_DATETIME_|" + "|".join(rf"\${re.escape(n)}" for n in names) + ")", template):
        if piece == "$_DATETIME_":
            parts.append(F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))
        elif piece[:1] == "$" and piece[1:] in types:
            parts.append(as_text(F.col(piece[1:]), types[piece[1:]]))
        elif piece:
            parts.append(F.lit(piece))
    return df.select("*", F.concat(*parts).alias("mail"))


def limited_per_hour(df: DataFrame, most: int = 20, time: str = "TIME_LAST", order: str = "seq") -> DataFrame:
    """Records of which at most ``most`` lie in any sliding hour: a record passes if fewer passed in the hour before it.

    The state is the last ``most`` times that passed, so it is as good as
    empty after an hour without a record: the records between such silences
    are folded apart, in parallel. Only order and time go through the fold.
    """
    from collections import deque
    from collections.abc import Iterator

    import pyarrow as pa

    hour = 3_600_000_000
    times = df.select(F.col(order).alias("o"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"))
    # a row for each hour that has records; an empty hour between two is a silence of at least an hour
    hours = times.groupBy(F.floor(F.col("t") / hour).alias("h")).agg(F.min("o").alias("low"), F.max("o").alias("high"))
    upto = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    # islands of time must follow each other in the order of arrival too
    apart = (F.col("h") - F.lag("h").over(Window.orderBy("h")) >= 2) & (F.max("high").over(upto) < F.min("low").over(Window.orderBy("h").rowsBetween(0, Window.unboundedFollowing)))
    islands = hours.select("h", F.sum(F.when(apart, 1).otherwise(0)).over(Window.orderBy("h").rowsBetween(Window.unboundedPreceding, 0)).alias("island"))
    rows = times.withColumn("h", F.floor(F.col("t") / hour)).join(islands, "h").select("island", "o", "t")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sent = None, deque(maxlen=most)
        for b in batches:
            keep = []
            for island, t in zip(b.column("island").to_pylist(), b.column("t").to_pylist(), strict=True):
                if island != at:
                    at, sent = island, deque(maxlen=most)
                ok = len(sent) < most or t - sent[0] >= hour
                keep.append(ok)
                if ok:
                    sent.append(t)
            yield pa.RecordBatch.from_arrays([b.column("o")], ["_passed"]).filter(pa.array(keep))

    kind = df.schema[order].dataType.simpleString()
    passed = rows.repartition(parts, "island").sortWithinPartitions("island", "o").mapInArrow(run, f"_passed {kind}")
    return df.join(passed, F.col(order) == F.col("_passed"), "left_semi")


def ruled(df: DataFrame, rules: list[tuple[str, list[str], list[str]]]) -> dict[str, DataFrame]:
    """Alert rules (condition, actions, else-actions): the records of each action, ``drop`` ends a record's way."""
    out: dict[str, DataFrame] = {}
    left = df
    for condition, actions, otherwise in rules:
        met = filters.condition(df, condition)
        for names, part in ((actions, left.where(met)), (otherwise, left.where(~met))):
            for a in names:
                if a != "drop":
                    out[a] = out[a].unionByName(part) if a in out else part
        gone = F.lit(False)
        if "drop" in actions:
            gone = gone | met
        if "drop" in otherwise:
            gone = gone | ~met
        left = left.where(~gone)
    return out


def snapshot(df: DataFrame) -> DataFrame:
    """One row of counters as header and values, for a monitoring plugin."""
    return df.select(F.lit(",".join(df.columns)).alias("header"), F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("values"))


def peer_sets(df: DataFrame, tags: dict[int, str], span: int = 300) -> DataFrame:
    """Per window and configured prefix tag the distinct peers, the targets of its records (exact form of a membership filter)."""
    from ..functions.scalar import whole_seconds

    start = (F.floor(whole_seconds(F.col("TIME_LAST")) / span) * span).cast("long")
    names = F.create_map(*[F.lit(x) for item in tags.items() for x in item])
    rows = df.withColumn("window_start", start).withColumn("tag_name", names[F.col("PREFIX_TAG").cast("int")]).where("tag_name is not null")
    return rows.select("window_start", "tag_name", F.col("DST_IP").alias("peer")).distinct()


def upload_peers(peers: DataFrame, host: str, port: int, path: str, span: int = 300) -> None:
    """POST the peers of each window and tag, as lines, to ``path/TAG/FROM/TO/``.

    Rows stream in order through a task, so no set is held; a body ends where
    the next window or tag begins.
    """
    import http.client
    from itertools import groupby

    rows = peers.select("window_start", "tag_name", ips.text(F.col("peer")).alias("peer"))
    parts = int(peers.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(part) -> None:
        for (start, tag), group in groupby(part, key=lambda r: (r["window_start"], r["tag_name"])):
            link = http.client.HTTPConnection(host, port, timeout=30)
            link.request("POST", f"{path}/{tag}/{start}/{start + span}/", body=(r["peer"].encode() + b"\n" for r in group), encode_chunked=True, headers={"Transfer-Encoding": "chunked"})
            answer = link.getresponse()
            link.close()
            if answer.status >= 300:
                raise OSError(f"{path}: {answer.status} {answer.reason}")

    rows.repartition(parts, "window_start", "tag_name").sortWithinPartitions("window_start", "tag_name", "peer").foreachPartition(send)


def text_report(df: DataFrame, separator: str = "\t") -> DataFrame:
    return df.select(F.concat_ws(separator, *[as_text(F.col(n), k) for n, k in kinds(df).items()]).alias("value"))


def write_stored(df: DataFrame, path: str, codec: str = "zstd", append: bool = False) -> None:
    """Record a stream as Parquet; codecs are those of Parquet (zstd, snappy, gzip, lz4, uncompressed)."""
    df.write.mode("append" if append else "overwrite").option("compression", codec).parquet(path)


def send_lines(rows: DataFrame, host: str, port: int) -> None:
    """Send texts (column ``value``) as lines to a socket, one connection for each task."""
    import socket

    def send(part) -> None:
        link = None
        for r in part:
            link = link or socket.create_connection((host, port), 30)
            link.sendall(r["value"].encode() + b"\n")
        if link:
            link.close()

    rows.select("value").foreachPartition(send)


def send_mails(mails: DataFrame, host: str, port: int, sender: str, receiver: str, subject: str) -> None:
    """Send texts (column ``mail``) through a mail server, one connection for each task."""
    import smtplib
    from email.message import EmailMessage

    def send(part) -> None:
        server = None
        for r in part:
            server = server or smtplib.SMTP(host, port, timeout=30)
            m = EmailMessage()
            m["From"], m["To"], m["Subject"] = sender, receiver, subject
            m.set_content(r["mail"])
            server.send_message(m)
        if server:
            server.quit()

    mails.select("mail").foreachPartition(send)
