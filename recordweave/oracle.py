"""DuckDB text of the views and rules, for the SQL that checks the queries."""

from __future__ import annotations

from recordweave.functions import names as N
from recordweave.functions import text as T
from recordweave.sources import adapters as A


def dialect(sql: str) -> str:
    return sql.replace("as string)", "as varchar)").replace("'dd.MM.yyyy'", "'%d.%m.%Y'").replace("'dd-MM-yyyy'", "'%d-%m-%Y'").replace("'yyyy/MM/dd'", "'%Y/%m/%d'").replace("date_format(", "strftime(").replace("{", "").replace("}", "")


COORDINATION = """
select l_orderkey as row_idx, concat('Supplier#', cast(min(l_suppkey) as varchar), ' (', cast(1200000000 + l_orderkey as varchar), ')') as connectivity_applicant,
  concat('PS-', cast(min(l_partkey) as varchar)) as pooling_station,
  string_agg(concat(cast(cast(l_quantity as int) as varchar), ' MW: ', strftime(l_shipdate, '%d.%m.%Y'), case when l_returnflag = 'R' then ' (Commissioned)' else '' end), '; ' order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as schedule_text,
  case l_orderkey % 3 when 0 then 'Effective' when 1 then 'Not effective' else 'Likely to be operationalized' end as status_text,
  case when l_orderkey % 4 = 0 then concat('Bay no. ', cast(min(l_suppkey) + 1 as varchar), ' & 220') else 'line' end as scope_text
from lineitem group by l_orderkey
"""


def views(*names: str) -> str:
    """A WITH clause of the named views; more definitions may follow after a comma."""
    text = {n: (COORDINATION if n == "coordination" else dialect(sql)) for n, (sql, _) in A.VIEWS.items()}
    return "WITH " + ", ".join(f"{n} AS ({text[n]})" for n in names) if all(n in text for n in names) else ""


def words(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def clean(c: str) -> str:
    return f"(CASE WHEN lower(trim({c})) IN ({words(T.NULL_WORDS)}) THEN NULL ELSE nullif(trim({c}), '') END)"


def squeeze(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


def normalize_id(c: str) -> str:
    return f"regexp_replace(lower({squeeze(c)}), '[^a-z0-9/\\-]', '', 'g')"


def long_numbers(c: str) -> str:
    return f"coalesce(regexp_extract_all({clean(c)}, '\\b\\d{{6,}}\\b'), [])"


def numeric_ids(c: str) -> str:
    return f"(CASE WHEN len({long_numbers(c)}) > 0 THEN array_to_string({long_numbers(c)}, ', ') ELSE {clean(c)} END)"


def numeric_ids_strip(c: str) -> str:
    return f"(CASE WHEN len({long_numbers(c)}) > 0 THEN array_to_string(list_transform({long_numbers(c)}, lambda x: coalesce(nullif(ltrim(x, '0'), ''), '0')), ', ') ELSE {clean(c)} END)"


def ids_by_space(c: str) -> str:
    return f"list_filter(string_split_regex(coalesce({c}, ''), '[,;\\s]+'), lambda x: x <> '')"


def state(c: str) -> str:
    named = " ".join(f"WHEN contains(lower({clean(c)}), '{s}') THEN '{s}'" for s in sorted(T.STATES, key=len, reverse=True))
    return f"(CASE {named} WHEN contains({clean(c)}, ',') THEN nullif(lower(trim(string_split({clean(c)}, ',')[-1], ' .')), '') END)"


def status(c: str) -> str:
    v = clean(c)
    return f"(CASE WHEN contains(lower({v}), 'withdraw') THEN 'Withdrawn' WHEN contains(lower({v}), 'revoke') THEN 'Revoked' WHEN contains(lower({v}), 'grant') THEN 'granted' ELSE {v} END)"


def mode_bucket(c: str) -> str:
    return f"(CASE WHEN regexp_matches({clean(c)}, '(?i)LOA|PPA') THEN 'LOA or PPA' WHEN {clean(c)} IS NOT NULL THEN 'Land BG' END)"


def developer(c: str) -> str:
    return f"(CASE WHEN NOT regexp_matches(upper({clean(c)}), ' LOA|CRITERION|APPLYING') THEN {clean(c)} END)"


def project_type(c: str) -> str:
    p = "'(?i)(solar|wind|bess|hybrid)(?:\\s*\\(([^)]*)\\))?'"
    name = "CASE lower(k) WHEN 'solar' THEN 'Solar' WHEN 'wind' THEN 'Wind' WHEN 'bess' THEN 'BESS' ELSE 'Solar+Wind' END"
    return f"nullif(array_to_string(list_transform(list_zip(regexp_extract_all({clean(c)}, {p}, 1), regexp_extract_all({clean(c)}, {p}, 2)), lambda z: (CASE lower(z[1]) WHEN 'solar' THEN 'Solar' WHEN 'wind' THEN 'Wind' WHEN 'bess' THEN 'BESS' ELSE 'Solar+Wind' END) || (CASE WHEN coalesce(trim(z[2]), '') <> '' THEN ' (' || trim(z[2]) || ')' ELSE '' END)), ' + '), '')" if name else ""


def voltage_text(c: str) -> str:
    return f"coalesce(nullif(regexp_extract({clean(c)}, '(?i)(\\d{{2,3}})\\s*kV', 1), '') || ' kV', {clean(c)})"


def voltage_key(c: str) -> str:
    v = f"regexp_replace(lower({c}), '[\\s\\-_]+', '', 'g')"
    return f"(CASE WHEN contains({v}, '220') THEN '220kv' WHEN contains({v}, '400') THEN '400kv' END)"


def name_key(c: str) -> str:
    cut = f"regexp_replace(lower(trim(coalesce({c}, ''))), '\\s*(pvt\\.?\\s*ltd\\.?|ltd\\.?|llp|private\\s+limited|limited)\\s*$', '')"
    return f"trim(regexp_replace(regexp_replace({cut}, '[.\\-,;:()]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def date_text(c: str) -> str:
    v = clean(c)
    return f"coalesce(nullif(regexp_extract({v}, '\\b\\d{{2}}[./-]\\d{{2}}[./-]\\d{{4}}\\b'), ''), nullif(regexp_extract({v}, '\\b\\d{{4}}[./-]\\d{{2}}[./-]\\d{{2}}\\b'), ''), nullif(regexp_extract({v}, '\\b\\d{{1,2}}\\s+[A-Za-z]{{3,9}}\\s+\\d{{4}}\\b'), ''))"


def parse_date(c: str) -> str:
    """The two numeric forms; the driver tables have no spelled months."""
    d = f"regexp_replace({c}, '[/-]', '.', 'g')"
    return f"CAST(coalesce(try_strptime(nullif(regexp_extract({d}, '\\b\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}\\b'), ''), '%d.%m.%Y'), try_strptime(nullif(regexp_extract({d}, '\\b\\d{{4}}\\.\\d{{2}}\\.\\d{{2}}\\b'), ''), '%Y.%m.%d')) AS DATE)"


def mw_total(c: str, commissioned: bool = False) -> str:
    p = "(?i)([\\d,]+\\.?\\d*)\\s*MW[^()]{0,80}?\\(?\\s*Commissioned\\s*\\)?" if commissioned else "(?i)([\\d,]+\\.?\\d*)\\s*MW"
    return f"round(list_sum(list_transform(regexp_extract_all({c}, '{p}', 1), lambda x: try_cast(replace(x, ',', '') AS DOUBLE))), 2)"


def is_effective(c: str) -> str:
    return f"(contains(lower({c}), 'effective') AND NOT regexp_matches(lower({c}), '\\bnot\\s+effective\\b|\\bnon[\\s-]?effective\\b'))"


def bay_numbers(c: str) -> str:
    """Bay numbers of both kinds of lists, each once, in order of their place; voltages go."""
    lists = "list_concat(" + ", ".join(f"regexp_extract_all(coalesce({c}, ''), '{p}', 1)" for p in T.BAY_PATTERNS) + ")"
    found = f"list_filter(flatten(list_transform({lists}, lambda x: regexp_extract_all(upper(x), '[A-Z]?\\d+[A-Z]?'))), lambda x: x NOT IN ('220', '400', '765'))"
    return f"array_to_string(list_filter({found}, lambda x, i: list_position({found}, x) = i), ' | ')"


# --- names made of titles: the rules in SQL ---------------------------------------------------------------------------
def spaced(c: str) -> str:
    return f"trim(regexp_replace(replace({c}, '_', ' '), '\\s+', ' ', 'g'))"


def stem(c: str) -> str:
    return f"regexp_replace({dialect(c)}, '\\.[^.]*$', '')"


def extension(c: str) -> str:
    return f"lower(coalesce(nullif(regexp_extract({dialect(c)}, '(\\.[^.]*)$', 1), ''), '.pdf'))"


def unnumbered(c: str) -> str:
    return spaced(f"trim(regexp_replace(regexp_replace({c}, '^\\d{{6,}}', ''), '^[_\\- ]+', ''))")


def ordinal(n: str) -> str:
    return f"({n} || CASE WHEN ({n}) % 100 BETWEEN 10 AND 20 THEN 'th' WHEN ({n}) % 10 = 1 THEN 'st' WHEN ({n}) % 10 = 2 THEN 'nd' WHEN ({n}) % 10 = 3 THEN 'rd' ELSE 'th' END)"


def group(c: str, pattern: str, k: int = 1) -> str:
    return f"nullif(regexp_extract({c}, '{pattern}', {k}), '')"


def nct_name(c: str) -> str:
    s, number = spaced(stem(c)), f"CAST({group(spaced(stem(c)), chr(92) + 'b(' + chr(92) + 'd{1,3})' + chr(92) + 'b')} AS INT)"
    shown = f"lower({group(s, '(?i)' + chr(92) + 'b(' + chr(92) + 'd{1,3}(?:st|nd|rd|th))' + chr(92) + 'b')})"
    return f"coalesce(coalesce({shown}, {ordinal(number)}) || '_NCT_MoM' || {extension(c)}, coalesce(nullif({s}, ''), 'file') || {extension(c)})"


def meeting_label(c: str) -> str:
    s = spaced(f"regexp_replace(regexp_replace({dialect(c)}, '\\d{{10,}}', '', 'g'), '^\\d+[_\\-\\s]*', '')")
    p = "(?i)(\\d{1,3})(st|nd|rd|th)?\\s*CMETS[-\\s]*([A-Z]{2,3})"
    special = f"CASE WHEN regexp_matches(lower({s}), 'additional\\s*agenda[-\\s]*\\d*') THEN 'Additional Agenda_' WHEN contains(lower({s}), 'revised agenda') THEN 'Revised Agenda_' WHEN contains(lower({s}), 'corrigendum') THEN 'Minutes Corrigendum_' WHEN contains(lower({s}), 'addendum') THEN 'Addendum of Minutes_' WHEN regexp_matches(lower({s}), 'annex|exhibit') THEN 'Annex_' ELSE '' END"
    return f"({special}) || coalesce({group(s, p)} || coalesce({group(s, p, 2)}, 'th') || ' CMETS-' || upper({group(s, p, 3)}), {group(s, '(?i)(' + chr(92) + 'd{1,3})' + chr(92) + 's*CMETS')} || 'th CMETS', {s})"


def coordination_label(c: str, notice: str) -> str:
    s = f"regexp_replace({spaced('trim(regexp_replace(' + dialect(c) + ', ' + chr(39) + '^' + chr(92) + 'd+[_' + chr(92) + '-' + chr(92) + 's]*' + chr(39) + ', ' + chr(39) + chr(39) + '))')}, '\\s*\\(\\d+\\)\\s*$', '')"

    def without(x: str, *openings: str) -> str:
        for o in openings:
            x = f"trim(regexp_replace({x}, '(?i)^{o}\\s*', ''))"
        return x

    told = without(s, "meeting\\s+notice\\s*&\\s*agenda\\s*(for)?", "meeting\\s+notice\\s*(for)?", "notice\\s*(for)?", "agenda\\s*(for)?")
    s = f"(CASE WHEN {notice} THEN {told} ELSE {without(s, 'minutes' + chr(92) + 's*(of)?', 'mom' + chr(92) + 's*(of)?')} END)"
    has = lambda p: f"regexp_matches({s}, '(?i){p}')"
    word = lambda k: has(chr(92) + "b" + k + chr(92) + "b")
    kind = f"CASE WHEN {word('jcc')} THEN 'JCC' WHEN {word('jccm')} THEN 'JCCM' WHEN {word('jcm')} THEN 'JCM' END"
    region = "CASE " + " ".join(f"WHEN {word(k)} THEN '{k}'" for k in ("NER", "NR", "ER", "WR", "SR")) + f" WHEN {has('north[ -]eastern')} THEN 'NER' WHEN {has('northern')} THEN 'NR' WHEN {has('western')} THEN 'WR' WHEN {has('southern')} THEN 'SR' WHEN {has('eastern')} THEN 'ER' END"
    number = f"lower({group(s, '(?i)' + chr(92) + 'b(' + chr(92) + 'd{1,3}(?:st|nd|rd|th))' + chr(92) + 'b')})"
    codes = "(?i)\\b(NER|NR|ER|WR|SR)(?:\\s*[-/]\\s*(NER|NR|ER|WR|SR))+\\b"
    return (
        f"coalesce({number} || ' ' || ({kind}) || '-' || ({region}), CASE WHEN {word('special')} THEN coalesce('Special ' || coalesce({kind}, 'JCC') || ' ' || upper({group(s, codes)}) || '-' || upper({group(s, codes, 2)}),"
        f" 'Special ' || ({kind}) || '-' || ({region})) END, {s})"
    )


def calendar_name(c: str) -> str:
    junk = "(?i)\\b(annexure[-\\s]*a|draft|approved|final|dated|as on dated|as on)\\b"
    s = f"trim(regexp_replace(regexp_replace(regexp_replace(replace({stem(c)}, '_', ' '), '^\\d+\\s*', ''), '{junk}', '', 'g'), '\\s+', ' ', 'g'))"
    d = f"replace({group(s, '(' + chr(92) + 'd{2}[-.]' + chr(92) + 'd{2}[-.]' + chr(92) + 'd{2,4})')}, '.', '-')"
    return f"'Bidding Calendar' || coalesce(' ' || CASE WHEN length({d}) = 8 THEN left({d}, 6) || '20' || right({d}, 2) ELSE {d} END, '') || {extension(c)}"


def bulk_name(c: str) -> str:
    s = unnumbered(stem(c))
    year, month = group(s, "(20\\d{2})[\\s_]?(\\d{2})"), group(s, "(20\\d{2})[\\s_]?(\\d{2})", 2)
    run = lambda k: group(s, "(\\d{2})(\\d{2})(20\\d{2})", k)
    last = f"CASE WHEN CAST({month} AS INT) IN (1, 3, 5, 7, 8, 10, 12) THEN '31' WHEN CAST({month} AS INT) IN (4, 6, 9, 11) THEN '30' ELSE '28' END"
    return f"'Bulk Consumer' || coalesce(' ' || coalesce({group(s, '(' + chr(92) + 'd{2}-' + chr(92) + 'd{2}-' + chr(92) + 'd{4})')}, ({last}) || '-' || {month} || '-' || {year}, {run(1)} || '-' || {run(2)} || '-' || {run(3)}), '') || {extension(c)}"


def revocation_name(c: str) -> str:
    s = unnumbered(stem(c))
    date = f"coalesce({group(f'lower({s})', 'upto' + chr(92) + 's+([a-z]+[' + chr(39) * 2 + chr(92) + '-' + chr(92) + 'd]*)')}, {group(f'lower({s})', 'published' + chr(92) + 's+in' + chr(92) + 's+([a-z]+' + chr(92) + 'd{2,4})')})"
    upto = f"coalesce(' upto ' || replace(replace({date}, {chr(39) * 4}, {chr(39) * 2}), '-', {chr(39) * 2}), '')"
    return f"(CASE WHEN contains(lower({s}), 'excluded') THEN 'Excluded from' || {upto} WHEN regexp_matches(lower({s}), 'revocation|upto') THEN 'Revocation' || {upto} ELSE coalesce(nullif({s}, ''), 'file') END) || {extension(c)}"


def margin_name(c: str) -> str:
    s = unnumbered(stem(c))
    squeezed = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    plain = lambda x: squeezed(f"regexp_replace(regexp_replace({x}, '(?i)\\b(approved|final|rev[-\\d]*)\\b', '', 'g'), '[-_]', ' ', 'g')")
    bays = squeezed(f"regexp_replace({s}, '(?i)\\b(approved|final|r\\d+)\\b', '', 'g')")
    has = lambda x: f"contains(lower({s}), '{x}')"
    cut = f"regexp_replace({s}, '(?i)^re\\s+', '')"
    return f"(CASE WHEN {has('allocation of bays')} THEN {bays} WHEN {has('non re ss margin')} THEN {plain(s)} WHEN {has('re ss margin')} THEN {plain(cut)} ELSE coalesce(nullif({s}, ''), 'file') END) || {extension(c)}"


def report_category(title: str) -> str:
    t = f"({dialect(title)} || ' ' || page_id || '.pdf')"
    has = lambda p: f"regexp_matches({t}, '{p}')"
    dated = f"regexp_matches(lower({t}), 'commissioned_(during|in)')"
    return f"CASE WHEN {has(N.RTM)} THEN 'rtm_uc' WHEN {has(N.TBCB)} AND {has(N.COMPLETED)} THEN 'tbcb_completed' WHEN {has(N.TBCB)} AND {has(N.UNDER_CONSTRUCTION)} THEN 'tbcb_uc' WHEN {has(N.UNDER_CONSTRUCTION)} AND NOT {dated} THEN 'tbcb_uc' WHEN {has(N.COMPLETED)} AND NOT {dated} THEN 'tbcb_completed' END"


def keyword_in(c: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({dialect(c)}, '(?i)(^|[^A-Za-z]){w}([^A-Za-z]|$)') THEN '{w}'" for w in N.KEYWORDS) + " END"
