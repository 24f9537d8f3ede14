"""Pieces of the checking SQL, in the dialect of the checking engine."""

from __future__ import annotations

from flowvigil.functions.uris import NORMALIZE_STEPS, WORD_SEPARATORS
from flowvigil.sources.patterns import VENDOR_PATTERNS

STATIC = r"(regexp_matches(uri, '\.css|\.js|\.png|\.jpg|\.bmp|\.ico') or contains(uri, '.jsp'))"
HTTP_LINE = (
    """concat('<13> ', marker, ' {"Uri":"', uri, '","SrcIp":"', srcip, '","DstIp":"', dstip, """
    """'","Method":"GET","Date":"', strftime(make_timestamp(epoch_s * 1000000), """
    """'%Y-%m-%d %H:%M:%S'), '","Seq":', event_id, '}')"""
)
NETFLOW_LINE = (
    """concat('sensor send a message: [[{"SrcIp":"', srcip, '","DstIp":"', dstip, '","SrcPort":', """
    """srcport, ',"dstPort":', dstport, ',"Proto":"', proto, '","starttime":', starttime, """
    """',"LastTime":', lasttime, ',"recordtime":', recordtime, """
    """case when uppkts is null then '' else concat(',"UpPkts":', uppkts) end, ',"DownPkts":', """
    """downpkts, ',"ups":', ups, ',"downs":', downs, ',"Proto7":"http","Seq":', event_id, '}]]')"""
)
SYSLOG_LINE = (
    "concat(cast(event_id as string), repeat('|!x', 28), '|!', reportip, '|!pad|!', body, tail)"
)


def decoded(uri: str) -> str:
    """Stray percent signs without look-ahead: mark the good ones, escape the rest."""
    marked = rf"regexp_replace({uri}, '%([0-9a-fA-F]{{2}})', chr(1) || '\1', 'g')"
    escaped = f"replace(replace({marked}, '%', '%25'), chr(1), '%')"
    return f"lower(url_decode(replace({escaped}, '+', ' ')))"


def normalized(text: str) -> str:
    for pattern, placeholder in NORMALIZE_STEPS:
        text = f"regexp_replace({text}, '{pattern}', '{placeholder}', 'g')"
    return text


def tokens(text: str) -> str:
    return rf"array_to_string(regexp_extract_all({text}, '[a-z0-9]+|[^\s]'), '|')"


def cleaned(uri: str) -> str:
    return tokens(normalized(decoded(uri)))


def words(text: str) -> str:
    split = f"string_split_regex(lower({text}), '{WORD_SEPARATORS}')"
    return f"array_to_string(list_filter({split}, lambda w: w <> ''), ' ')"


def hashed(text: str) -> str:
    """31-based hash over UTF-16 units, signed."""
    units = (
        f"flatten(list_transform(string_split({text}, ''), lambda c: case when unicode(c) < 65536 "
        "then [greatest(unicode(c), 0)] else [55296 + ((unicode(c) - 65536) >> 10), "
        "56320 + ((unicode(c) - 65536) & 1023)] end))"
    )
    total = (
        f"list_reduce(list_transform({units}, lambda u: cast(u as bigint)), "
        "lambda h, u: (h * 31 + u) & 4294967295, cast(0 as bigint))"
    )
    return f"case when {total} > 2147483647 then {total} - 4294967296 else {total} end"


def epoch_of_text(text: str) -> str:
    """Epoch second of the three forms a log time has."""
    apache = rf"regexp_extract({text}, '^\d+/\w+/\d+:\d+:\d+:\d+')"
    iso = rf"regexp_extract({text}, '^\d+-\d+-\d+ \d+:\d+:\d+')"
    return (
        rf"case when regexp_full_match({text}, '\d+') then cast(substr({text}, 1, 10) as bigint) "
        f"else coalesce(cast(epoch(try_strptime({apache}, '%d/%b/%Y:%H:%M:%S')) as bigint), "
        f"cast(epoch(try_strptime({iso}, '%Y-%m-%d %H:%M:%S')) as bigint), 0) end"
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pattern_id(line: str) -> str:
    cases = " ".join(
        f"when regexp_matches({line}, {_quoted(p.pattern)}) then '{p.id}'" for p in VENDOR_PATTERNS
    )
    return f"case {cases} end"


def captured(line: str, name: str) -> str:
    """Group of the winning pattern, by the column ``logruleid``."""
    cases = " ".join(
        f"when '{p.id}' then regexp_extract({line}, {_quoted(p.pattern)}, {dict(p.fields)[name]})"
        for p in VENDOR_PATTERNS
        if name in dict(p.fields)
    )
    return f"case logruleid {cases} end" if cases else "null"


RULE_VALUES = r"""(values (0, 'R1', 'any', 'any', 'union\s+select'),
  (1, 'R2', '10\.0\.0\.3', 'any', 'or 1=1'), (2, 'R3', '10.0.0.9', 'any', 'or\s+1=1'),
  (3, 'R4', 'any', 'any', 'id=')) as r(rule_pos, ruleid, sourceip, destip, pattern)"""

RULE_MATCH = rf"""
flows as (
  select event_id, {HTTP_LINE} as line, uri, {decoded('uri')} as plain, srcip, dstip, epoch_s
  from fx_http where marker <> 'other' and not {STATIC}),
matched as (
  select event_id, any_value(line) as line, any_value(uri) as uri, any_value(srcip) as srcip,
    any_value(dstip) as dstip, any_value(epoch_s) as epoch_s, arg_min(ruleid, rule_pos) as ruleid
  from flows left join {RULE_VALUES}
    on (srcip = sourceip or not contains(sourceip, '\.'))
    and (dstip = destip or not contains(destip, '\.'))
    and regexp_matches(plain, pattern)
  group by event_id)"""


def features(table: str, label: str, keys: str = "srcip, proto, dstip, recordtime") -> str:
    return f"""
select srcip, dstip, recordtime, proto, {label} as label,
  cast(sum(lasttime - starttime) as double) as spandtime,
  cast(sum(uppkts + downpkts) as double) as packernum,
  cast(sum(ups + downs) as double) as bytesize,
  cast(count(distinct srcport) as double) as src_flow_port_num,
  cast(count(distinct dstport) as double) as dst_flow_port_num,
  case when proto in ('tcp', 'TCP') then 1.0e0 else 0.0e0 end as tcp,
  case when proto in ('udp', 'UDP') then 1.0e0 else 0.0e0 end as udp,
  cast(count(*) as double) as flownum,
  string_agg(distinct cast(srcport as string), ',' order by cast(srcport as string)) as srcports,
  string_agg(distinct cast(dstport as string), ',' order by cast(dstport as string)) as dstports
from {table} group by {keys}"""


def attack_features(label: str, keys: str) -> str:
    return f"""
select srcip, dstip, recordtime, proto, {label} as label,
  cast(sum(costtime) as double) as spandtime,
  cast(sum(packernum) as double) as packernum,
  cast(sum(bytesize) as double) as bytesize,
  cast(count(distinct srcport) as double) as src_flow_port_num,
  cast(count(distinct dstport) as double) as dst_flow_port_num,
  case when proto in ('tcp', 'TCP') then 1.0e0 else 0.0e0 end as tcp,
  case when proto in ('udp', 'UDP') then 1.0e0 else 0.0e0 end as udp,
  cast(count(*) as double) as flownum
from fx_attack group by {keys}"""
