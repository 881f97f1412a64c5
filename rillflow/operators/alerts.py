"""Converters from detections to alert documents.

Each converter is a list of Columns over the detection's fields, so a
conversion is a projection in the JVM. :func:`document` makes the JSON text;
absent parts are nulls, which JSON leaves out. The two volatile fields, ID and
CreateTime, are added there only, so all the rest can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ip as ips
from ..functions.scalar import ascii_only, minutes_text
from . import joins

FORMAT = "IDEA0"
#: Transport names by protocol number.
TRANSPORT = {1: "icmp", 6: "tcp", 17: "udp"}
#: Services of a brute-force alert.
LOGIN_SERVICES = {21: "FTP", 22: "SSH", 23: "TELNET", 3389: "MS-WBT-SERVER", 2179: "VMRDP", 5900: "VNC"}


def when_text(time: Column) -> Column:
    return F.date_format(time.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def strings(*values: str | Column) -> Column:
    return F.array(*[F.lit(v) if isinstance(v, str) else v for v in values])


def _transport(protocol: Column) -> Column:
    out = F.lit(None).cast("string")
    for n, name in TRANSPORT.items():
        out = F.when(protocol == n, F.lit(name)).otherwise(out)
    return out


def party(ip: Column | None = None, **parts: Column) -> Column:
    """A Source or Target: IP4 or IP6 by the address' version, and further parts."""
    columns = []
    if ip is not None:
        columns += [F.when(ips.is_v4(ip), F.array(ips.text(ip))).alias("IP4"), F.when(F.octet_length(ip) == 16, F.array(ips.text(ip))).alias("IP6")]
    return F.struct(*columns, *[c.alias(n) for n, c in parts.items()])


def party_of_many(addresses: Column, **parts: Column) -> Column:
    """A party with a list of addresses given as text."""
    v4, v6 = F.filter(addresses, lambda x: ~x.contains(":")), F.filter(addresses, lambda x: x.contains(":"))
    some = lambda a: F.when(F.size(a) > 0, a)
    return F.struct(some(v4).alias("IP4"), some(v6).alias("IP6"), *[c.alias(n) for n, c in parts.items()])


def node(software: str, *kinds: str, window: Column | None = None) -> Column:
    parts = [F.lit("undefined").alias("Name"), strings("rillflow", software).alias("SW"), strings(*kinds).alias("Type")]
    return F.array(F.struct(*parts, *([window.alias("AggrWin")] if window is not None else [])))


def _times(first: str | None, last: str) -> dict[str, Column]:
    out = {"DetectTime": when_text(F.col(last)), "CeaseTime": when_text(F.col(last))}
    return out | ({"EventTime": when_text(F.col(first))} if first else {})


def _select(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    return df.select(F.lit(FORMAT).alias("Format"), *[c.alias(n) for n, c in parts.items()])


c = F.col


def amplification(df: DataFrame) -> DataFrame:
    """Amplified denial of service by a reflector."""
    service = F.when(c("SRC_PORT") == 53, "domain").when(c("SRC_PORT") == 123, "ntp")
    proto = F.when(service.isNotNull(), strings("udp", service))
    text = F.when(c("SRC_PORT") == 53, "DNS amplification").when(c("SRC_PORT") == 123, "NTP amplification")
    source = party(c("SRC_IP"), Type=strings("Backscatter"), InFlowCount=c("REQ_FLOWS"), InPacketCount=c("REQ_PACKETS"), InByteCount=c("REQ_BYTES"), OutFlowCount=c("RSP_FLOWS"), OutPacketCount=c("RSP_PACKETS"), OutByteCount=c("RSP_BYTES"), Proto=proto)
    target = party(c("DST_IP"), InFlowCount=c("RSP_FLOWS"), InPacketCount=c("RSP_PACKETS"), InByteCount=c("RSP_BYTES"), Proto=proto)
    return _select(df, _times("TIME_FIRST", "TIME_LAST") | {"Category": strings("Availability.DDoS"), "Description": text, "FlowCount": c("RSP_FLOWS"), "PacketCount": c("RSP_PACKETS"), "ByteCount": c("RSP_BYTES"), "Source": F.array(source), "Target": F.array(target), "Node": node("amplification", "Flow", "Statistical")})


def volume_attack(df: DataFrame) -> DataFrame:
    """Denial of service against a target."""
    return _select(df, _times("TIME_FIRST", "TIME_LAST") | {"AltNames": strings(c("EVENT_ID").cast("string")), "Category": strings("Availability.DoS"), "Description": F.lit("Volume of traffic and number of its sources increased."), "ByteCount": c("BYTES"), "Target": F.array(party(c("DST_IP"))), "Node": node("ddos", "Flow", "Statistical")})


def generated_domains(df: DataFrame) -> DataFrame:
    """A bot that asks for generated names: the bot and the controller."""
    bot = F.struct(F.when(ips.is_v4(c("SRC_IP")), F.array(ips.text(c("SRC_IP")))).alias("IP4"), F.when(~ips.is_v4(c("SRC_IP")), F.array(ips.text(c("SRC_IP")))).alias("IP6"), strings("Botnet").alias("Type"), F.lit(None).cast("array<string>").alias("Hostname"))
    none = F.lit(None).cast("array<string>")
    controller = F.struct(none.alias("IP4"), none.alias("IP6"), strings("Botnet", "CC").alias("Type"), F.array(c("DNS_Q_NAME")).alias("Hostname"))
    return _select(df, {"DetectTime": when_text(c("TIME_LAST")), "Category": strings("Intrusion.Botnet"), "Description": F.lit("Botnet trying to communicate with control server using DGA"), "Source": F.array(bot, controller), "Node": F.array(F.struct(strings("rillflow", "dga").alias("SW")))})


def dns_tunnel(df: DataFrame) -> DataFrame:
    """Tunnel types 1 (requests) and 4 to 8 (responses); others are no alerts."""
    side = F.when(c("TUNNEL_TYPE") == 1, " observed in requests").otherwise(" observed in responses")
    note = F.concat(F.lit("Example of used domain name: "), ascii_only(c("TUNNEL_DOMAIN")))
    return _select(df.where(c("TUNNEL_TYPE").isin(1, 4, 5, 6, 7, 8)), _times("TIME_FIRST", "TIME_LAST") | {"Category": strings("Anomaly.Connection"), "Description": F.concat(F.lit("Communication tunnel over DNS"), side), "Note": note, "FlowCount": c("TUNNEL_CNT_PACKET"), "Source": F.array(party(c("SRC_IP"), Proto=strings("udp", "domain"))), "Node": node("dnstunnel", "Flow", "Statistical", "Content")})


def horizontal_scan(df: DataFrame, window: str = "00:05:00") -> DataFrame:
    """One port on many addresses; the sample of targets is what is set of DST_IP0 to DST_IP15."""
    named = [x for x in (f"DST_IP{i}" for i in range(16)) if x in df.columns]
    hosts = F.filter(F.array(*[F.when(F.hex(c(n)).rlike("[1-9A-F]"), ips.text(c(n))) for n in named]), lambda x: x.isNotNull()) if named else F.array().cast("array<string>")
    target = party_of_many(hosts, Proto=strings("tcp"), Port=F.array(c("DST_PORT")), Imprecise=F.lit(True))
    return _select(df, _times("TIME_FIRST", "TIME_LAST") | {"Category": strings("Recon.Scanning"), "Description": F.lit("Horizontal scan using TCP SYN"), "FlowCount": c("ADDR_CNT"), "Source": F.array(party(c("SRC_IP"), Proto=strings("tcp"))), "Target": F.array(target), "Node": node("haddrscan", "Flow", "Statistical", window=F.lit(window))})


def vertical_scan(df: DataFrame, window: str = "00:05:00") -> DataFrame:
    """Many ports: ``dst_ips`` maps address text to ports; several addresses make a block scan."""
    hosts = F.array_sort(F.map_keys("dst_ips"))
    count = F.aggregate(F.map_values("dst_ips"), F.lit(0).cast("long"), lambda a, x: a + x)
    text = F.when(F.size(hosts) > 1, "Block portscan using TCP SYN").otherwise("Vertical scan using TCP SYN")
    return _select(df, _times("TIME_FIRST", "TIME_LAST") | {"Category": strings("Recon.Scanning"), "Description": text, "FlowCount": count, "Source": F.array(party_of_many(F.array("src_ip"), Proto=strings("tcp"))), "Target": F.array(party_of_many(hosts, Proto=strings("tcp"))), "Node": node("vportscan", "Flow", "Statistical", window=F.lit(window))})


def brute_force(df: DataFrame) -> DataFrame:
    """Login attempts; only warning type 2."""
    service = F.lit("")
    for port, name in LOGIN_SERVICES.items():
        service = F.when(c("DST_PORT") == port, name).otherwise(service)
    proto = F.when(service != "", F.array(_transport(c("PROTOCOL")), F.lower(service))).otherwise(F.array(_transport(c("PROTOCOL"))))
    text = F.concat(F.lit("Multiple unsuccessful login attempts"), F.when(service != "", F.concat(F.lit(" on "), service)).otherwise(""))
    return _select(df.where("WARDEN_TYPE = 2"), {"DetectTime": when_text(c("DETECTION_TIME")), "Category": strings("Attempt.Login"), "Description": text, "FlowCount": c("EVENT_SCALE"), "Source": F.array(party(c("SRC_IP"), Proto=proto)), "Target": F.array(F.struct(F.array(c("DST_PORT")).alias("Port"), proto.alias("Proto"))), "Node": node("brute_force", "Flow", "Statistical")})


def learned_ssh(df: DataFrame) -> DataFrame:
    """Failed logins over SSH as a model counts them."""
    note = F.format_string("Machine Learning model recognized approx. %d unsuccessful login attempts from %s against SSH server %s", c("ATTEMPTS"), ips.text(c("SRC_IP")), ips.text(c("DST_IP")))
    return _select(df, {"DetectTime": when_text(c("EVENT_TIME")), "Category": strings("Attempt.Login"), "Description": F.lit("Multiple unsuccessful SSH login attempts"), "Note": note, "Source": F.array(party(c("SRC_IP"), Proto=strings("tcp", "ssh"))), "Target": F.array(party(c("DST_IP"), Port=F.array(c("DST_PORT")), Proto=strings("tcp", "ssh"))), "Node": node("sshbruteforceml", "Flow", "Statistical", "MachineLearning")})


def miner(df: DataFrame) -> DataFrame:
    """A host that connects to a mining pool."""
    src, dst = ips.text(c("SRC_IP")), ips.text(c("DST_IP"))
    text = F.format_string("%s might be a miner, because it connected to %s:%d which is flagged as a mining pool server.", src, dst, c("DST_PORT"))
    return _select(df, _times("TIME_FIRST", "TIME_LAST") | {"Category": strings("Suspicious.Miner"), "Description": text, "Note": F.format_string("Source IP %s might be a miner.", src), "FlowCount": c("EVENT_SCALE"), "ConnCount": c("EVENT_SCALE"), "Source": F.array(party(c("SRC_IP"), Proto=strings("tcp"))), "Target": F.array(party(c("DST_IP"), Proto=strings("tcp"))), "Node": node("minerdetector", "Flow", "Blacklist")})


def sip_brute_force(df: DataFrame) -> DataFrame:
    """Event types 0 (attack), 1 (distributed attack) and 2 (scan of accounts)."""
    kind, breach = c("SBFD_EVENT_TYPE"), F.when(F.unix_micros(c("SBFD_BREACH_TIME").cast("timestamp")) != 0, when_text(c("SBFD_BREACH_TIME")))
    one = F.when(breach.isNotNull(), "Successful SIP BruteForce login attempt.").otherwise("SIP BruteForce login attempt.")
    many = F.when(breach.isNotNull(), "Successful distributed SIP BruteForce login attempt.").otherwise("Distributed SIP BruteForce login attempt.")
    text = F.when(kind == 0, one).when(kind == 1, many).otherwise("Scan of SIP user accounts.")
    proto = strings(F.when(c("SBFD_PROTOCOL") == 6, "tcp").otherwise("udp"), "sip")
    return _select(df.where(kind.isin(0, 1, 2)), {"EventTime": when_text(c("SBFD_EVENT_TIME")), "CeaseTime": when_text(c("SBFD_CEASE_TIME")), "BreachTime": F.when(kind < 2, breach), "Category": F.when(kind < 2, strings("Attempt.Login")).otherwise(strings("Recon.Scanning")), "Description": text, "Note": F.when(kind < 2, F.concat(F.lit("Event is related to user account: "), c("SBFD_USER"))), "ConnCount": c("SBFD_ATTEMPTS"), "Source": F.array(party(c("SBFD_SOURCE"), Proto=proto, Port=F.array(c("SRC_PORT")))), "Target": F.array(party(c("SBFD_TARGET"), Proto=proto, Port=F.array(c("DST_PORT")))), "Node": node("sip_brute_force", "Flow", "Statistical")})


def voip_fraud(df: DataFrame) -> DataFrame:
    """Guessing of dial plans; only event type 40."""
    source = party(c("SRC_IP"), Proto=strings("sip"), UserAgent=F.array("VOIP_FRAUD_USER_AGENT"), SIPFrom=F.array("VOIP_FRAUD_SIP_FROM"))
    target = F.struct(strings("sip").alias("Proto"), F.array("VOIP_FRAUD_SIP_TO").alias("SIPTo"))
    return _select(df.where("EVENT_TYPE = 40"), {"DetectTime": when_text(c("DETECTION_TIME")), "EventTime": when_text(c("TIME_FIRST")), "Category": strings("Attempt.Login"), "Description": F.lit("SIP Dial-plan guessing"), "ConnCount": c("VOIP_FRAUD_INVITE_COUNT"), "MaxPrefixLength": c("VOIP_FRAUD_PREFIX_LENGTH"), "TriedPrefixCount": c("VOIP_FRAUD_PREFIX_EXAMINATION_COUNT"), "SuccessfulCalls": c("VOIP_FRAUD_SUCCESSFUL_CALL_COUNT"), "Source": F.array(source), "Target": F.array(target), "Node": node("voip_fraud", "Flow", "Statistical", "Content")})


def rootkit(df: DataFrame) -> DataFrame:
    """Attempts to wake a rootkit, with a confidence by kind of evidence."""
    transport = _transport(c("PROTOCOL"))
    proto, has_port = F.when(transport.isNotNull(), F.array(transport)), c("PROTOCOL").isin(6, 17)
    source = party(c("SRC_IP"), Proto=proto, Port=F.when(has_port, F.array("SRC_PORT")), Type=strings("Botnet", "CC"))
    target = party(c("DST_IP"), Proto=proto, Port=F.when(has_port, F.array("DST_PORT")), Type=strings("Botnet"))
    magic = c("VENOM") == 255
    note = F.when(magic, "Activation was attempted by a packet with a magic string in its payload.").otherwise(F.format_string("Activation was attempted by %d packets with src_port + tcp_seq = 1221.", c("VENOM")))
    confidence = F.when(c("SRC_PORT") == 1221, 0.05).when(magic, 0.9).otherwise(0.3)
    return _select(df, _times("TIME_FIRST", "TIME_LAST") | {"Category": strings("Intrusion.Botnet", "Malware.Rootkit"), "Description": F.concat(F.lit("Attempt to activate VENOM rootkit on "), ips.text(c("DST_IP")), F.lit(".")), "Note": note, "Confidence": confidence, "PacketCount": c("PACKETS"), "ByteCount": c("BYTES"), "Source": F.array(source, target), "Node": node("venom", "Packet", "DPI")})


_IN = r"^in: (\d+) flows, (\d+) packets; out: (\d+) flows, (\d+) packets; approx. (\d+) source addresses"
_OUT = r"^out: (\d+) flows, (\d+) packets; in: (\d+) flows, (\d+) packets; approx. (\d+) destination addresses"
SCAN, DENIAL, DNS_AMPLIFICATION, LOGIN = 2, 10, 15, 30


def host_events(df: DataFrame) -> DataFrame:
    """Scan (2), denial of service (10), DNS amplification (15) and login attacks (30) seen in host statistics."""
    kind, scale = c("EVENT_TYPE"), c("EVENT_SCALE")
    set_ = lambda ip: F.hex(c(ip)).rlike("[1-9A-F]")
    src, dst, tcp = set_("SRC_IP"), set_("DST_IP"), c("PROTOCOL") == 6
    part = lambda pattern, i, met: F.when(met & c("NOTE").rlike(pattern), F.regexp_extract("NOTE", pattern, i).try_cast("long"))
    denial = kind == DENIAL
    coming, going = denial & dst & c("NOTE").rlike(_IN), denial & src & c("NOTE").rlike(_OUT)
    transport = _transport(c("PROTOCOL"))
    plain = F.when(transport.isNotNull(), F.array(transport))
    dns, ssh = strings("udp", "domain"), strings("tcp", "ssh")
    address = lambda ip, met: [F.when(met & ips.is_v4(c(ip)), F.array(ips.text(c(ip)))).alias("IP4"), F.when(met & (F.octet_length(ip) == 16), F.array(ips.text(c(ip)))).alias("IP6")]
    source = F.struct(
        *address("SRC_IP", src),
        F.when((kind == DNS_AMPLIFICATION) & src, strings("Backscatter")).alias("Type"),
        F.when((kind == DNS_AMPLIFICATION) & src, F.array(F.lit(53))).alias("Port"),
        F.when(kind == DNS_AMPLIFICATION, dns).when((kind == SCAN) | (denial & src), plain).alias("Proto"),
        part(_OUT, 1, going).alias("OutFlowCount"), part(_OUT, 2, going).alias("OutPacketCount"), part(_OUT, 3, going).alias("InFlowCount"), part(_OUT, 4, going).alias("InPacketCount"),
        part(_IN, 5, coming).alias("Count"), F.when(coming, "Number of sources is approximate").alias("Note"),
    )
    target = F.struct(
        *address("DST_IP", dst & (kind != SCAN)),
        F.when(kind == LOGIN, F.array(F.lit(22))).alias("Port"),
        F.when(kind == LOGIN, ssh).when(kind == DNS_AMPLIFICATION, dns).when(denial & dst, plain).alias("Proto"),
        part(_IN, 1, coming).alias("InFlowCount"), part(_IN, 2, coming).alias("InPacketCount"), part(_IN, 3, coming).alias("OutFlowCount"), part(_IN, 4, coming).alias("OutPacketCount"),
        part(_OUT, 5, going).alias("Count"), F.when(going, "Number of destinations is approximate").alias("Note"),
    )
    has_source = src | (kind == SCAN) | coming
    has_target = (kind == LOGIN) | ((kind != SCAN) & dst) | going
    flood = F.when(tcp, "Abnormally high number of TCP SYN packets").otherwise("Abnormally high number of packets")
    text = F.when(kind == SCAN, "Horizontal port scan").when(kind == LOGIN, "SSH dictionary/bruteforce attack").when(denial, flood).otherwise("Abnormally high number of large DNS replies")
    victim = F.when(dst, F.concat(F.lit(" received by "), ips.text(c("DST_IP")))).otherwise(F.concat(F.lit(" emitted by "), ips.text(c("SRC_IP"))))
    note = F.when(denial, F.concat(flood, victim)).when((kind == DNS_AMPLIFICATION) & src, F.concat(ips.text(c("SRC_IP")), F.lit(" sent abnormally high number of large DNS replies"))).when(kind == DNS_AMPLIFICATION, F.concat(ips.text(c("DST_IP")), F.lit(" received abnormally high number of large DNS replies")))
    category = F.when(kind == SCAN, "Recon.Scanning").when(kind == LOGIN, "Attempt.Login").otherwise("Availability.DoS")
    return _select(df.where(kind.isin(SCAN, DENIAL, DNS_AMPLIFICATION, LOGIN)), {"EventTime": when_text(c("TIME_FIRST")), "CeaseTime": when_text(c("TIME_LAST")), "Category": F.array(category), "Description": text, "Note": note, "FlowCount": F.when(kind == LOGIN, 2 * scale).otherwise(scale), "ConnCount": F.when(kind.isin(SCAN, LOGIN), scale), "Source": F.when(has_source, F.array(source)), "Target": F.when(has_target, F.array(target)), "Node": node("hoststats", "Flow", "Statistical")})


def blacklisted(df: DataFrame, lists: DataFrame) -> DataFrame:
    """Communication with listed addresses or names (``type`` ip, or url/dns); records of unknown lists go.

    The blacklist's category decides the roles; without an answer the partner is a target and not a source.
    """
    named = lists.select(c("blacklist_id").alias("_list"), "name", "category", c("source").alias("list_source"))
    rows = joins.looked_up(df, "blacklist_id", named, "_list", how="inner")
    is_ip, answered = c("type") == "ip", c("tgt_sent_flows") > 0
    transport = _transport(c("protocol"))
    proto = F.when(transport.isNotNull(), F.array(transport))
    ports = F.when(c("protocol").isin(6, 17) & (F.size("source_ports") > 0), c("source_ports"))
    roles = {"Intrusion.Botnet": (("CC", "Botnet"), ("Botnet",)), "Suspicious.Miner": (("PoolServer",), ("Miner",)), "Suspicious.Booter": (("Booter",), None), "Fraud.Phishing": (("Phishing",), None)}
    listed, partner = F.when(~is_ip, strings("OriginBlacklist")), F.lit(None).cast("array<string>")
    for category, (one, two) in roles.items():
        listed = F.when(c("category") == category, strings(*one)).otherwise(listed)
        if two:
            partner = F.when((c("category") == category) & answered, strings(*two)).otherwise(partner)
    sent, got = c("src_sent_flows") > 0, answered
    name = lambda met: F.when(~is_ip & met, F.array("source_url"))
    none = F.lit(None)
    blank = lambda t: none.cast(t)
    own = F.array(F.when(is_ip, c("source")).otherwise(c("source_ip")))
    keys = ["Proto", "Type", "Port", "Hostname", "URL", "OutFlowCount", "OutByteCount", "OutPacketCount", "InFlowCount", "InByteCount", "InPacketCount"]
    values = [proto, listed, ports, name(c("is_only_fqdn")), name(~c("is_only_fqdn")), *[F.when(is_ip & sent, c(f"src_sent_{x}").cast("long")) for x in ("flows", "bytes", "packets")], *[F.when(got, c(f"tgt_sent_{x}").cast("long")) for x in ("flows", "bytes", "packets")]]
    source = party_of_many(own, **dict(zip(keys, values, strict=True)))
    empty = [proto, partner, blank(df.schema["source_ports"].dataType), blank("array<string>"), blank("array<string>"), *[blank("long")] * 6]
    other = party_of_many(c("targets"), **dict(zip(keys, empty, strict=True)))
    what = F.when(is_ip, "IP").when(c("is_only_fqdn"), "domain name").otherwise("URL")
    text = F.when(answered, F.concat(F.lit("Suspicious communication with "), what, F.lit(" listed on "), c("name"), F.lit(" blacklist"))).otherwise("Blacklisted IP tried to communicate with host (with no response)")
    total = lambda x: F.when(is_ip, (c(f"src_sent_{x}") + c(f"tgt_sent_{x}")).cast("long"))
    return _select(rows, _times("ts_first", "ts_last") | {"Category": F.array("category"), "Description": text, "FlowCount": total("flows"), "PacketCount": total("packets"), "ByteCount": total("bytes"), "Source": F.when(answered, F.array(source, other)).otherwise(F.array(source)), "Target": F.when(~answered, F.array(other)), "Ref": F.array("list_source"), "Node": node("blacklist", "Flow", "Blacklist", window=minutes_text(c("agg_win_minutes")))})


def mining_pool(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Communication with a listed pool; a pool in the own prefixes is a second source, else the target."""
    rows = joins.guarded(df.withColumn("_pool", ips.parse(c("source"))), "_pool", prefixes)
    transport = _transport(c("protocol"))
    proto = F.when(transport.isNotNull(), F.array(transport))
    miners = party_of_many(c("targets"), Proto=proto, Type=F.lit("Miner"))
    pool = party_of_many(F.array("source"), Proto=proto, Type=F.lit("MiningPool"))
    who, ports = F.array_join("targets", ", "), F.array_join(c("source_ports").cast("array<string>"), ", ")
    note = F.when(c("guarded"), F.concat(F.lit("IP "), c("source"), F.lit(" and port(s) "), ports, F.lit(" is listed as a mining pool server, and IP "), who, F.lit(" communicated with it."))).otherwise(F.concat(F.lit("Detected possible CryptoCurrency mining by IP "), who, F.lit(", because of observed communication with "), c("source"), F.lit(":"), ports, F.lit(" listed as a mining pool server.")))
    return _select(rows, _times("ts_first", "ts_last") | {"Category": strings("Suspicious.Miner"), "Description": F.lit("Possible CryptoCurrency mining identified by connection with a mining pool."), "Note": note, "Source": F.when(c("guarded"), F.array(miners, pool)).otherwise(F.array(miners)), "Target": F.when(~c("guarded"), F.array(pool)), "Node": node("blacklist", "Flow", "Blacklist", window=minutes_text(c("agg_win_minutes")))})


def passed(df: DataFrame) -> DataFrame:
    """Documents that are alerts already."""
    return df


CONVERTERS: dict[str, Callable] = {f.__name__: f for f in (amplification, volume_attack, generated_domains, dns_tunnel, horizontal_scan, vertical_scan, brute_force, learned_ssh, miner, sip_brute_force, voip_fraud, rootkit, host_events, blacklisted, mining_pool, passed)}


def document(alerts: DataFrame) -> DataFrame:
    """Each alert as JSON text in ``value``, with an ID and the time of its making."""
    made = alerts.withColumns({"ID": F.uuid(), "CreateTime": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")})
    return made.select(F.to_json(F.struct(*made.columns)).alias("value"))
