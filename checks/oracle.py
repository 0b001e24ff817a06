"""DuckDB SQL for the registered queries, written against the tables alone.

Patterns are the plain ones (no look-behind, no possessive repeats), so the
SQL also checks the rewrites that keep Spark's patterns linear.
"""

from __future__ import annotations

from tidemill.functions import fixed_values as fixed

from . import queries as q
from .notes import duck_note
from .rich_pages import URL, duck_blocks, duck_markdown, duck_text

BLANKS = "'" + fixed.BLANKS + "'"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def is_blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


def number(x: str) -> str:
    """Text as a double, with the guard that the Spark side applies."""
    text = strip(x)
    return (
        f"case when regexp_full_match({text}, {quoted(fixed.NUMBER)}) "
        f"then try_cast(replace({text}, '_', '') as double) end"
    )


def sub(x: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


# Inputs -------------------------------------------------------------------------

TEXTS = f"""texts as (
  select 'd' || doc_id as id, text from documents
  union all select 'o' || o_orderkey, {duck_note()} from orders)"""


def _customers(left: str, right: str) -> str:
    return f"""select cast(c_custkey as varchar) as id, '{left}' || c_name || '{right}' as name,
    case when c_acctbal < 0 then '{left}' else c_mktsegment end as segment,
    case when c_acctbal > 9000 then '' else cast(c_acctbal as varchar) end as balance,
    cast(c_nationkey as varchar) as nation from customer"""


DIRTY = f"dirty as ({_customers('  ', chr(9) + ' ')} union all {_customers('', '')})"
COLUMNS = ["id", "name", "segment", "balance", "nation"]
STRIPPED = "stripped as (select " + ", ".join(f"{strip(c)} as {c}" for c in COLUMNS) + " from dirty)"

ITEMS = """items as (
  select l_returnflag as flag, cast(l_suppkey as varchar) as supplier,
    case when l_discount = 0 then 'n/a'
         when l_tax = 0 then ' ' || cast(l_extendedprice as varchar) || chr(9)
         when l_quantity = 1 then '1_000'
         else cast(l_extendedprice as varchar) end as price
  from lineitem)"""

CELLS = f"""wide as (
  select o_orderkey as row, cast(o_custkey as varchar) as customer,
    case when o_totalprice < 20000 then ' '
         else cast(cast(floor(o_totalprice) as bigint) // 1000 as varchar) || ','
              || lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as varchar), 3, '0') end as price,
    case when o_orderpriority = '5-LOW' then null else o_orderstatus end as status,
    strftime(o_orderdate, '%Y-%m-%d') as date,
    case when o_orderpriority = '1-URGENT' then cast(o_custkey as varchar) else o_orderpriority end as mixed
  from orders),
cells as (
  {" union all ".join(f"select '{c}' as col, row, {c} as value from wide" for c in q.PROFILED)}),
parsed as (
  select col, row, value, not {is_blank("value")} as present,
    {number("replace(value, ',', '')")} as num from cells),
base as (
  select col, count(*) as total_rows, count(*) filter (present) as non_null,
    count(distinct value) filter (present) as unique_count,
    count(num) filter (present) as n_num, min(num) filter (present) as low, max(num) filter (present) as high,
    avg(num) filter (present) as mean, median(num) filter (present) as median,
    stddev_samp(num) filter (present) as stdev
  from parsed group by col),
typed as (
  select *, case when n_num > 0 and n_num > 0.5 * non_null then 'numeric' else 'categorical' end as type from base),
top as (
  select col, rank, value, n from (
    select col, value, n, row_number() over (partition by col order by n desc, first_seen) as rank from (
      select col, value, count(*) as n, min(row) as first_seen from parsed where present group by col, value))
  where rank <= 5 and col in (select col from typed where type = 'categorical')),
sample as (
  select col, rank, value from (
    select col, value, row_number() over (partition by col order by row) as rank from parsed where present)
  where rank <= 3)"""

_ITEM = """'{"id":' || event_id || ',"type":"%s","value":' || value || ',"props":' || props || '}'"""
API = f"""landed as (
  select 'https://api.example.org/users/' || user_id as endpoint, cast(floor(value / 10) as int) + 1 as page,
    case when value > 300 then '{{oops'
      when event_type = 'signup' and value < 2 then '"text"'
      when event_type = 'click' then '[' || {_ITEM % "click"} || ']'
      when event_type = 'view' then '{{"items":[' || {_ITEM % "view"} || ',' || {_ITEM % "again"} || ']}}'
      when event_type = 'purchase' then '{{"results":[' || {_ITEM % "purchase"} || '],"data":[]}}'
      when event_type = 'signup' then '{{"next":null,"data":[' || {_ITEM % "signup"} || ']}}'
      else '{{"results":null,"data":[1]}}' end as body
  from events),
decoded as (
  select endpoint, page, try_cast(body as json) as v from landed where page between 1 and {q.API_MAX_PAGES}),
lists as (
  select endpoint, page, v,
    case when json_type(v) = 'ARRAY' then v
         when json_type(v) = 'OBJECT' then coalesce(json_extract(v, '$.results'), json_extract(v, '$.items'), json_extract(v, '$.data'))
    end as l from decoded),
unwrapped as (
  select endpoint, page, v, case when json_type(l) = 'ARRAY' then cast(json_extract(l, '$[*]') as json[]) end as items from lists),
full_pages as (select distinct endpoint, page from unwrapped where len(items) > 0),
numbered as (select endpoint, page, row_number() over (partition by endpoint order by page) as n from full_pages),
kept as (
  select u.endpoint, u.page, u.items from unwrapped u join numbered using (endpoint, page) where numbered.page = numbered.n),
records as (
  select endpoint, page, unnest(items) as record, generate_subscripts(items, 1) - 1 as position from kept)"""
RECORD = """select cast(json_extract_string(record, '$.id') as bigint) as id, json_extract_string(record, '$.type') as type,
  cast(json_extract_string(record, '$.value') as double) as value, json_extract_string(record, '$.absent') as absent from records"""

TURNS = """turns as (
  select conv_id as source, turn + 1 as page_no,
    case when role = 'system' then ' ' || chr(10) else ' ' || text || chr(10) end as text from conversations),
""" + f"""lines as (
  select source, page_no, '--- Page ' || page_no || ' ---' || chr(10) || {strip("text")} as line
  from turns where not {is_blank("text")}),
sizes as (
  select source, count(*) as pages, sum(length(line)) + 2 * (count(*) - 1) as chars from lines group by source)"""

# Texts --------------------------------------------------------------------------


def whitespace(x: str) -> str:
    return sub(sub(sub(x, r"\n{3,}", "\n\n"), r"[ \t]+", " "), r" *\n *", "\n")


def folded(x: str) -> str:
    for a, b in fixed.FOLDED_CHARACTERS.items():
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    return x


def masked_emails(x: str) -> str:
    return sub(x, r"\S+@\S+\.\S+", "[EMAIL]")


def without_controls(x: str) -> str:
    return sub(x, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]", "")


def cleaned(x: str) -> str:
    return strip(without_controls(folded(masked_emails(sub(whitespace(x), "<[^>]+>", "")))))


def cleaned_markdown(x: str) -> str:
    x = sub(x, r"(Skip to (main )?content|Jump to|Table of [Cc]ontents)\n?", "")
    x = sub(x, r"(?i)(We use cookies|Accept all|Cookie policy).*?\n", "")
    x = sub(x, r"[-=]{5,}", "---")
    x = sub(x, r"(?m)^#{1,6}\s*$", "")
    return cleaned(sub(x, r"\n{2,}(#{1,6})", "\n\n\\1"))


def deduplicated(x: str) -> str:
    parts = f"string_split({x}, chr(10) || chr(10))"
    keys = f"list_transform({parts}, lambda p: lower({strip('p')}))"
    return (
        f"(select array_to_string(list_filter(parts, lambda p, i: keys[i] <> '' and list_position(keys, keys[i]) = i), "
        f"chr(10) || chr(10)) from (select {parts} as parts, {keys} as keys))"
    )


def found(x: str, *patterns: str, group: int = 0) -> str:
    lists = [f"regexp_extract_all({x}, {quoted(p)}, {group})" for p in patterns]
    return lists[0] if len(lists) == 1 else "list_concat(" + ", ".join(lists) + ")"


def joined(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct({x})), '|')"


MONTHS = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
EMAILS = found("text", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}")
PHONES = found(
    "text", r"\+?1?[-.\s]?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}", r"\+\d{1,3}[-.\s]?\d{3,4}[-.\s]?\d{3,4}[-.\s]?\d{3,4}"
)
URLS = found("text", r"https?://(?:[-\w.]|(?:%[\da-fA-F]{2}))+[/\w\-._~:/?#\[\]@!$&'()*+,;=%]*")
DATES = found(
    "text", r"\d{4}-\d{2}-\d{2}", r"\d{1,2}/\d{1,2}/\d{2,4}", rf"(?i)\b{MONTHS}[a-z]*\s+\d{{1,2}},?\s+\d{{4}}\b",
    rf"(?i)\d{{1,2}}\s+{MONTHS}[a-z]*\s+\d{{4}}",
)
NAMES = (
    "list_filter(" + found("text", r"(?:^|[.!?]\s)([A-Z][a-z]+(?:\s+[A-Z][a-z]+)+)", group=1)
    + ", lambda n: not list_contains([" + ", ".join(map(quoted, fixed.NAME_STOP_WORDS))
    + "], regexp_extract(n, '^[A-Za-z]+')))"
)


def _money(pattern: str, code: str) -> str:
    return (
        f"list_transform({found('text', pattern)}, lambda m: {{'raw': {strip('m')}, "
        f"'amount': try_cast(regexp_replace(m, '[^0-9.]', '', 'g') as double), 'currency': {code}}})"
    )


MONEY = (
    "list_filter(list_concat("
    + ", ".join(
        [_money(rf"\{sign}[\d,]+(?:\.\d{{2}})?" if sign == "$" else rf"{sign}[\d,]+(?:\.\d{{2}})?", quoted(code))
         for sign, code in fixed.MONEY_PREFIXES.items()]
        + [_money(r"[\d,]+(?:\.\d{2})?\s*(?:USD|EUR|GBP|INR)", "regexp_extract(m, 'USD|EUR|GBP|INR')")]
    )
    + "), lambda e: e.amount is not null)"
)
_SPLIT = [r"(?s)^(.+?):\s*(.+)$", r"(?s)^(.+?)\s*=\s*(.+)$", r"(?s)^(.+?)\s*-\s*(.+)$"]


def _line_part(group: int) -> str:
    cases = " ".join(
        f"when regexp_matches(line, {quoted(p)}) then regexp_extract(line, {quoted(p)}, {group})" for p in _SPLIT
    )
    return strip(f"case {cases} end")


PAIRS = f"""textlines as (
  select id, {strip("unnest(string_split(text, chr(10)))")} as line,
    generate_subscripts(string_split(text, chr(10)), 1) as pos from texts),
split as (select id, pos, {_line_part(1)} as key, {_line_part(2)} as value from textlines),
pairs as (
  select id, key, arg_max(value, pos) as value from split where key is not null and key <> '' and length(key) < {fixed.PAIR_KEY_LIMIT}
  group by id, key)"""
ENTITIES = f"""found as (
  select id, list_distinct({EMAILS}) as emails, list_distinct({PHONES}) as phones, list_distinct({URLS}) as urls,
    list_distinct({DATES}) as dates, {MONEY} as monetary from texts),
paired as (select id, list(key || '=' || value order by key || '=' || value) as pairs,
  list(key || ': ' || value) as shown from pairs group by id),
entities as (
  select id, emails, phones, urls, dates, monetary, coalesce(pairs, []) as pairs, coalesce(shown, []) as shown
  from found left join paired using (id))"""
KINDS = {"email": "emails", "phone": "phones", "url": "urls", "date": "dates", "money": "monetary", "pair": "pairs"}
TOTAL = " + ".join(f"len({c})" for c in KINDS.values())

# Web pages: end tags close the nearest open paragraph, an article closes all of them.

_BODY = "html"
for _tag in fixed.FURNITURE_TAGS:
    _BODY = f"regexp_replace({_BODY}, '(?s)<{_tag}\\b.*?</{_tag}>', '<cut>', 'g')"
_BODY = f"regexp_replace({_BODY}, '(?s)<!--.*?-->', '<cut>', 'g')"
_DECODED = "replace(replace(replace(token, '&quot;', '\"'), '&#x27;', ''''), '&amp;', '&')"
HTML = f"""tokens as (
  select page_id, token, pos, lower(regexp_extract(token, '^<(/?[a-zA-Z0-9]+)', 1)) as tag from (
    select page_id, unnest(t) as token, generate_subscripts(t, 1) as pos from (
      select page_id, regexp_extract_all({_BODY}, '<[^>]*>|[^<]+') as t from pages))),
leveled as (
  select *, sum(case tag when 'p' then 1 when '/p' then -1 else 0 end) over (partition by page_id order by pos) as depth
  from tokens),
opened as (select page_id, pos, tag, depth from leveled where tag in ('p', 'h1', 'h2', 'h3', 'h4', 'li', 'pre', 'code')),
ended as (
  select o.page_id, o.pos, o.tag, min(e.pos) as stop from opened o join leveled e
    on e.page_id = o.page_id and e.pos > o.pos and (
      e.tag in ('/article', '/body', '/html') or (o.tag = 'p' and e.depth < o.depth) or (o.tag <> 'p' and e.tag = '/' || o.tag))
  group by all),
blocks as (
  select page_id, row_number() over (partition by page_id order by pos) - 1 as position, tag, text from (
    select n.page_id, n.pos, n.tag, string_agg({strip(_DECODED)}, '' order by t.pos) as text
    from ended n join leveled t on t.page_id = n.page_id and t.pos > n.pos and t.pos < n.stop and t.token[1] <> '<'
    group by all)
  where text <> ''),
markdown as (
  select page_id, coalesce(string_agg(case tag when 'h1' then chr(10) || '# ' || text || chr(10)
    when 'p' then text else 'unexpected' end, chr(10) order by position), '') as markdown
  from pages left join blocks using (page_id) group by page_id)"""
FILE = (
    "replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '.', '_') || '_' || "
    "coalesce(nullif(replace(trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), '/', '_'), ''), 'index') || '.md'"
)

# Chunks and vectors ---------------------------------------------------------------


SPLIT = r"[\s\x0b\x1c-\x1f]+"


def word_chunks(source: str, keys: str) -> str:
    size, overlap = q.CHUNK_WORDS
    return f"""worded as (
  select {keys}, list_filter(regexp_split_to_array(text, '{SPLIT}'), lambda w: w <> '') as w from {source}),
placed as (select {keys}, w, unnest(range(0, len(w), {size - overlap})) as start from worded),
chunks as (
  select {keys}, start // {size - overlap} as chunk_index, array_to_string(w[start + 1 : start + {size}], ' ') as chunk
  from placed)"""


def character_chunks(source: str, size: int, overlap: int) -> str:
    """Chunks ``(id, chunk_index, chunk)`` of ``source(id, text)``.

    Level by level, texts too long are cut before each separator; neighbouring
    short pieces form a run, and a fold over each run finds where its chunks
    start and end.
    """
    ctes = [f"todo0 as (select id, cast([] as bigint[]) as path, text from {source})"]
    for level, separator in enumerate(fixed.CHUNK_SEPARATORS):
        last = level == len(fixed.CHUNK_SEPARATORS) - 1
        sep = quoted(separator)
        cut = (
            "regexp_extract_all(text, '(?s).')"
            if last
            else f"list_transform(string_split(text, {sep}), lambda x, i: case when i = 1 then x else {sep} || x end)"
        )
        here = "true" if last else f"contains(text, {sep})"
        too_long = "false" if last else f"length(piece) >= {size}"
        ctes.append(f"""cut{level} as (
  select id, path, unnest(l) as piece, generate_subscripts(l, 1) as idx from (
    select id, path, list_filter({cut}, lambda x: x <> '') as l from todo{level} where {here})),
pieces{level} as (
  select id, path, idx, piece, {too_long} as too_long,
    sum(case when {too_long} then 1 else 0 end) over (partition by id, path order by idx) as run from cut{level}),
todo{level + 1} as (
  select id, list_append(path, idx) as path, piece as text from pieces{level} where too_long
  union all select id, path, text from todo{level} where not ({here}))""")
    atoms = " union all ".join(
        f"select id, path, run, idx, piece from pieces{level} where not too_long"
        for level in range(len(fixed.CHUNK_SEPARATORS))
    )
    before = "cums[acc.i] - coalesce(cums[{0} - 1], 0)"
    fits = f"({before.format('j')} <= {overlap} and {before.format('j')} + lens[x.i] <= {size})"
    ctes.append(f"""runs as (
  select id, list_append(path, min(idx)) as path, list(piece order by idx) as pieces,
    list(length(piece) order by idx) as lens, list(cum order by idx) as cums from (
    select *, sum(length(piece)) over (partition by id, path, run order by idx) as cum from ({atoms}))
  group by id, run, path),
folded as (
  select id, path, pieces, list_reduce(
    list_transform(range(1, len(pieces) + 1), lambda i: {{'i': i, 's': cast(1 as bigint), 'out': cast([] as struct(a bigint, b bigint)[])}}),
    lambda acc, x: case when {before.format('acc.s')} + lens[x.i] > {size}
      then {{'i': x.i, 's': list_filter(range(acc.s, x.i + 1), lambda j: j = x.i or {fits})[1],
             'out': list_append(acc.out, {{'a': acc.s, 'b': acc.i}})}}
      else {{'i': x.i, 's': acc.s, 'out': acc.out}} end) as f
  from runs),
bounds as (
  select id, path, pieces, unnest(list_append(f.out, {{'a': f.s, 'b': f.i}})) as e,
    generate_subscripts(list_append(f.out, {{'a': f.s, 'b': f.i}}), 1) as k from folded),
chunked as (
  select id, path, k, {strip("array_to_string(pieces[e.a : e.b], '')")} as chunk from bounds),
chunks as (
  select id, row_number() over (partition by id order by path, k) - 1 as chunk_index, chunk from chunked where chunk <> '')""")
    return ",\n".join(ctes)


def hashed(source: str, key: str, text: str, name: str = "vectors") -> str:
    return f"""{name}_words as (
  select {key}, unnest(list_filter(regexp_split_to_array(lower({text}), '{SPLIT}'), lambda w: w <> '')) as w from {source}),
{name}_counts as (
  select {key}, cast('0x' || substr(md5(w), 1, 4) as int) % 64 as bucket, count(*) as n from {name}_words group by all),
{name} as (
  select {key}, bucket, cast(n / sqrt(sum(n * n) over (partition by {key})) as float) as weight from {name}_counts)"""


def text_query(name: str) -> str:
    return f"with {TEXTS} select id, {name} as result from texts"


def oracle() -> dict[str, str]:
    fills = {
        "segment": f"case when {is_blank('segment')} then 'none' else segment end",
        "balance": f"case when {is_blank('balance')} then '0' else balance end",
    }
    allowed = ", ".join(map(quoted, q.ALLOWED["segment"]))
    final = f"""{DIRTY}, {STRIPPED}, filled as (
      select id, name, {fills['segment']} as segment, {fills['balance']} as balance from (select distinct * from stripped))
    select id, name, segment as market, balance, 'N/A' as added from filled where segment in ({allowed})"""
    sql = {
        "csv_scan": f"with {DIRTY} select " + ", ".join(f"nullif({c}, '') as {c}" for c in COLUMNS) + " from dirty",
        "csv_roundtrip": """select cast(s_suppkey as varchar) as id, 'the "' || s_name || '",' || chr(10) || 'Ltd ' as name,
            case when s_acctbal < 5000 then '' else cast(s_acctbal as varchar) end as balance from supplier""",
        "clean_strip": f"with {DIRTY}, {STRIPPED} select * from stripped",
        "clean_dedup": f"with {DIRTY}, {STRIPPED} select distinct * from stripped",
        "clean_fill": f"""with {DIRTY} select id, name, {fills['segment']} as segment, {fills['balance']} as balance, nation,
            'N/A' as added from dirty""",
        "clean_filter_rows": f"with {DIRTY} select * from dirty where segment in ('BUILDING', '  ')",
        "clean_drop_rename": f"with {DIRTY} select id, name, segment as market, balance from dirty",
        "clean_dataset": f"with {final}",
        "csv_job": f"with {final}",
        "csv_job_profile": f"with {DIRTY} " + " union all ".join(
            f"""select '{c}' as "column", count(*) as total_rows, count(*) filter ({strip(c)} <> '') as non_null,
            count(*) filter ({strip(c)} = '') as null_count, count(distinct {c}) filter ({strip(c)} <> '') as unique_count,
            '{'categorical' if c in ('name', 'segment') else 'numeric'}' as type from dirty"""
            for c in COLUMNS
        ),
        "clean_report": f"""with {DIRTY}, {STRIPPED}, kept as (select distinct * from stripped)
            select 'rows_removed' as change, '' as target, (select count(*) from stripped) - (select count(*) from kept) as n
            union all select 'cells_filled', 'segment', count(*) from kept where {is_blank('segment')}
            union all select 'cells_filled', 'balance', count(*) from kept where {is_blank('balance')}
            union all select 'cells_filled', 'added', count(*) from kept""",
        "clean_report_observed": f"""with {DIRTY}, {STRIPPED}, kept as (select distinct * from stripped)
            select 'rows_removed' as change, '' as target, (select count(*) from stripped) - (select count(*) from kept) as n
            union all select 'cells_filled', 'segment', count(*) from kept where {is_blank('segment')}
            union all select 'cells_filled', 'balance', count(*) from kept where {is_blank('balance')}
            union all select 'cells_filled', 'added', count(*) from kept""",
        "profile_completeness": f"""with {CELLS} select col as "column", total_rows, non_null, total_rows - non_null as null_count,
            round((total_rows - non_null) / total_rows * 100, 1) as null_pct, unique_count from base""",
        "profile_types": f'with {CELLS} select col as "column", n_num, type from typed',
        "profile_numeric": f"""with {CELLS} select col as "column", low as min, high as max, round(mean, 2) as mean,
            round(median, 2) as median, round(stdev, 2) as stdev from typed where type = 'numeric'""",
        "profile_top5": f'with {CELLS} select col as "column", rank, value, n from top',
        "profile_sample": f'with {CELLS} select col as "column", rank, value from sample',
        "profile_dataset": f"""with {CELLS} select col as "column", total_rows, non_null, total_rows - non_null as null_count,
            round((total_rows - non_null) / total_rows * 100, 1) as null_pct, unique_count, type,
            case when type = 'numeric' then low end as min, case when type = 'numeric' then high end as max,
            case when type = 'numeric' then round(mean, 2) end as mean,
            case when type = 'numeric' then round(median, 2) end as median,
            case when type = 'numeric' and n_num > 1 then round(stdev, 2) end as stdev,
            case when type = 'categorical' then (
              select string_agg(value || '=' || n, '|' order by rank) from top where top.col = typed.col) end as top_5,
            case when type = 'categorical' then (
              select string_agg(value, '|' order by rank) from sample where sample.col = typed.col) end as sample
            from typed""",
        "clean_whitespace": text_query(whitespace("text")),
        "clean_html_tags": text_query(sub("text", "<[^>]+>", "")),
        "mask_urls": text_query(sub("text", r"https?://\S+", "[URL]")),
        "mask_emails": text_query(masked_emails("text")),
        "fold_unicode": text_query(folded("text")),
        "drop_control": text_query(without_controls("text")),
        "clean_text": text_query(cleaned("text")),
        "clean_markdown": text_query(cleaned_markdown("text")),
        "dedup_paragraphs": text_query(deduplicated("text")),
        "text_preview": text_query("substring(text, 1, 150)"),
        "extract_emails": text_query(joined(EMAILS)),
        "extract_phones": text_query(joined(PHONES)),
        "extract_urls": text_query(joined(URLS)),
        "extract_dates": text_query(joined(DATES)),
        "extract_names": text_query(joined(NAMES)),
        "clean_corpus": f"""with {TEXTS}, cleaned as (select id, {cleaned("text")} as text from texts)
            select id, {deduplicated("text")} as text from cleaned""",
        "cleaning_reduction": f"""select lang, chars_before, chars_after, round((1 - chars_after / chars_before) * 100, 1) as reduction_pct
            from (select lang, sum(length(text)) as chars_before, sum(length({cleaned("text")})) as chars_after from documents group by lang)""",
        "extract_money": f"""with {TEXTS}, found as (select id, {MONEY} as m from texts),
            flat as (select id, unnest(m) as e, generate_subscripts(m, 1) - 1 as position from found)
            select id, position, e.raw as raw, e.amount as amount, e.currency as currency from flat""",
        "extract_kv": f"with {TEXTS}, {PAIRS} select id, key, value from pairs",
        "extract_all": f"""with {TEXTS}, {PAIRS}, {ENTITIES} select id, array_to_string(list_sort(emails), '|') as emails,
            array_to_string(list_sort(phones), '|') as phones, array_to_string(list_sort(urls), '|') as urls,
            array_to_string(list_sort(dates), '|') as dates,
            array_to_string(list_transform(monetary, lambda m: m.raw || ' ' || m.currency), '|') as monetary,
            array_to_string(pairs, '|') as key_value_pairs from entities""",
        "extract_totals": f"""with {TEXTS}, {PAIRS}, {ENTITIES} select count(*) as texts, cast(sum({TOTAL}) as bigint) as entities
            from entities""",
        "entity_counts": f"with {TEXTS}, {PAIRS}, {ENTITIES} "
        + " union all ".join(
            f"select '{k}' as kind, cast(sum(len({c})) as bigint) as n, count(*) filter (len({c}) > 0) as texts from entities"
            for k, c in KINDS.items()
        ),
        "entity_rows": f"with {TEXTS}, {PAIRS}, {ENTITIES} "
        + " union all ".join(
            f"select id as doc_id, '{k}' as kind, unnest("
            + {"money": "list_transform(monetary, lambda m: m.raw)", "pair": "shown"}.get(k, c)
            + ") as value from entities"
            for k, c in KINDS.items()
        ),
        "text_dir_scan": f"""with files as (select lang, doc_id % {q.FOLDER_PARTS} as part, string_agg(text || chr(10), '' order by doc_id) as content
              from documents group by all) select lang, part, length(content) as chars, md5(content) as digest from files""",
        "api_pages_unwrap": f"""with {API} select endpoint, page, count(*) as responses,
            cast(coalesce(sum(len(items)), 0) as bigint) as items, count(*) filter (items is null) as without_list,
            count(*) filter (v is null) as errors from unwrapped group by endpoint, page""",
        "api_pages_stop": f"with {API} select endpoint, max(page) as last_page, count(*) as responses from kept group by endpoint",
        "api_records": f"""with {API} select endpoint, page, position, cast(json_extract_string(record, '$.id') as bigint) as id,
            cast(json_extract_string(record, '$.props.k') as bigint) as k from records""",
        "project_fields": f"with {API} {RECORD}",
        "api_to_dataset": f"with {API} {RECORD}",
        "project_columns": "select c_name, cast(null as varchar) as absent, c_custkey from customer",
        "api_request_plan": """with e as (select 'https://api.example.org/c/' || c_custkey || case when c_acctbal < 0 then '?debt=1' else '' end
            as endpoint, unnest(range(1, 6)) as page from customer)
            select endpoint, page, endpoint || case when contains(endpoint, '?') then '&' else '?' end || 'page=' || page || '&per_page=30'
            as url from e""",
        "jsonl_roundtrip": f"""with {DIRTY} select id, name, segment, nullif(balance, '') as balance, nation, balance = '' as null_written
            from dirty""",
        "json_array_sink": """select case when c_custkey = (select min(c_custkey) from customer) then '[' else ',' end as lead, *
            from customer""",
        "doc_assemble": f"""with {TURNS} select source, 0 as part, 1 as parts, string_agg(line, chr(10) || chr(10) order by page_no) as text,
            count(*) as pages, 'table' as extractor, length(string_agg(line, chr(10) || chr(10) order by page_no)) as chars from lines group by source""",
        "doc_assemble_parts": f"""with {TURNS}, p as (select source, (page_no - 1) // 4 as part,
            string_agg(line, chr(10) || chr(10) order by page_no) as text from lines group by all)
            select source, part, count(*) over (partition by source) as parts, text, sizes.pages, 'table' as extractor, sizes.chars
            from p join sizes using (source)""",
        "dedup_corpus": f"""with {TEXTS}, parts as (select id, unnest(string_split(text, chr(10) || chr(10))) as part,
              unnest(range(len(string_split(text, chr(10) || chr(10))))) as pos from texts),
            firsts as (select id, pos, part from (select *, row_number() over (partition by lower({strip('part')}) order by id, pos) as n
              from parts where {strip('part')} <> '') where n = 1),
            kept as (select id, string_agg(part, chr(10) || chr(10) order by pos) as text from firsts group by id)
            select id, coalesce(kept.text, '') as text from (select id from texts) left join kept using (id)""",
        "csv_mixed_headers": """select cast(s_suppkey as varchar) as id, s_name || chr(13) || '"x"' || chr(10) || ',' || s_suppkey as name,
            case when s_suppkey % 2 = 1 then cast(s_nationkey as varchar) end as nation from supplier""",
        "html_blocks_rich": duck_blocks(),
        "html_markdown_rich": f"select o_orderkey as page_id, case when o_orderkey % 5 <> 0 then {duck_markdown()} end as markdown from orders",
        "scrape_manifest_errors": f"""with m as (select o_orderkey as page_id, {duck_text(URL)} as url, {duck_markdown()} as markdown,
              case when o_orderkey % 7 = 0 then 'timeout' when o_orderkey % 5 = 0 then 'no body' end as error from orders)
            select page_id, url, case when error is null then 'success' else 'error' end as status, case when error is null then length(markdown) end as chars,
              case when error is null then {FILE} end as file, error from m""",
        "doc_sizes": f"with {TURNS} select source, pages, chars from sizes",
        "doc_assemble_totals": f"""with {TURNS} select count(*) as documents, sum(pages) as pages,
            sum(chars) + 2 * (count(*) - 1) as chars from sizes""",
        "doc_dir_summary": f"""select role, conv_id % {q.FOLDER_PARTS} as part, md5(text) as digest, cast(null as varchar) as error,
            row_number() over (partition by role, conv_id % {q.FOLDER_PARTS} order by conv_id, turn) as page_no from conversations""",
        "combine_documents": f"""with {TURNS}, whole as (select string_agg(line, chr(10) || chr(10) order by source, page_no) || chr(10) || chr(10) as t from lines),
            whole_lines as (select unnest(string_split(t, chr(10))) as l from whole)
            select l as line, count(*) - cast(l = '' as int) as lines from whole_lines group by l""",
        "html_blocks": f"with {HTML} select page_id, position, tag, text from blocks",
        "html_to_markdown": f"with {HTML} select page_id, markdown from markdown",
        "html_h1": f"with {HTML} select page_id, text from blocks where tag = 'h1'",
        "url_filename": f"select page_id, url, {FILE} as file from pages",
        "scrape_manifest": f"""with {HTML} select page_id, url, 'success' as status, length(markdown) as chars, {FILE} as file,
            cast(null as varchar) as error from pages join markdown using (page_id)""",
        "manifest_last_wins": f"select url, max(page_id) as page_id, 'success' as status, {FILE} as file from pages group by url",
        "manifest_collisions": f"""with both_urls as (select url from pages union all select url || '?again=1' from pages)
            select {FILE} as file, count(distinct url) as urls from both_urls group by 1 having count(distinct url) > 1""",
        "markdown_sink": f"with {HTML} select {FILE} as file, markdown as text from pages join markdown using (page_id)",
        "web_documents": f"""with {HTML} select {deduplicated(cleaned_markdown("markdown"))} as content, url as source,
            'page_' || page_id || '.md' as filename from pages join markdown using (page_id) where markdown <> ''""",
        "chunk_words": f"with {TEXTS}, {word_chunks('texts', 'id')} select id, chunk_index, chunk from chunks",
        "embed_hashing": f"""with {TEXTS}, {hashed('texts', 'id', 'text')}
            select id, bucket, round(cast(weight as double), 5) as weight from vectors""",
        "vector_store_build": f"""with {word_chunks('documents', 'doc_id, source')},
            named as (select doc_id || '_' || chunk_index as chunk_id, source, chunk from chunks),
            {hashed('named', 'chunk_id, source', 'chunk')}
            select chunk_id, source, bucket, round(cast(weight as double), 5) as weight from vectors""",
        "vector_store_cells": "select vec_id, label, len(embedding) as dims, true as nearest_cell from embeddings",
        "vector_ann_recall": "select count(*) as queries, true as recall_ok from embeddings where embedding is not null",
        "vector_topk": """with pairs as (
              select a.vec_id as query_id, b.vec_id, b.label,
                list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (cast(z[1] as double) - z[2]) * (cast(z[1] as double) - z[2]))) as score
              from embeddings a cross join embeddings b),
            ranked as (select *, row_number() over (partition by query_id order by round(score, 9), vec_id) as rank from pairs)
            select query_id, rank, vec_id, label, round(score, 6) as score from ranked where rank <= 4""",
        "semantic_query": f"""with {hashed('documents', 'doc_id', 'text', 'd')}, {hashed('benchmark', 'item_id', 'text', 'b')},
            d_all as (select doc_id, lang, bucket, coalesce(weight, 0) as weight from documents cross join (select unnest(range(64)) as bucket)
              left join d using (doc_id, bucket)),
            b_all as (select item_id, bucket, coalesce(weight, 0) as weight from benchmark cross join (select unnest(range(64)) as bucket)
              left join b using (item_id, bucket)),
            scored as (select item_id, doc_id, lang, round(sum((cast(d_all.weight as double) - b_all.weight) * (cast(d_all.weight as double) - b_all.weight) order by bucket), 9) as score
              from d_all join b_all using (bucket) group by all),
            ranked as (select *, row_number() over (partition by item_id order by score, doc_id) as rank from scored)
            select item_id as query_id, rank, doc_id as chunk_id, lang, round(score, 6) as score from ranked where rank <= 4""",
    }
    sql["extraction_sink"] = sql["extract_all"]
    sql["chunk_chars"] = f"with {TEXTS}, {character_chunks('texts', *q.CHUNK_CHARACTERS)} select id, chunk_index, chunk from chunks"
    sql["chunk_documents"] = f"""with files as (select doc_id as id, text from documents), {character_chunks('files', *q.WEB_CHUNK)}
        select 'doc_' || id || '.txt_' || chunk_index as chunk_id, source, chunk_index, chunk as content
        from chunks join documents on doc_id = id"""
    web = f"""{HTML}, files as (
        select page_id as id, {deduplicated(cleaned_markdown("markdown"))} as text from markdown where markdown <> ''),
        {character_chunks('files', *q.WEB_CHUNK)}"""
    sql["web_corpus_summary"] = f"with {web} select count(distinct id) as pages, count(*) as chunks from chunks"
    sql["web_corpus_search"] = f"""with {web}, named as (select id * 1000000 + chunk_index as chunk_no, chunk from chunks),
        {hashed('named', 'chunk_no', 'chunk', 'd')}, {hashed('benchmark', 'item_id', 'text', 'b')},
        d_all as (select chunk_no, bucket, coalesce(weight, 0) as weight from named cross join (select unnest(range(64)) as bucket)
          left join d using (chunk_no, bucket)),
        b_all as (select item_id, bucket, coalesce(weight, 0) as weight from benchmark cross join (select unnest(range(64)) as bucket)
          left join b using (item_id, bucket)),
        scored as (select item_id, chunk_no, round(sum((cast(d_all.weight as double) - b_all.weight) * (cast(d_all.weight as double) - b_all.weight) order by bucket), 9) as score
          from d_all join b_all using (bucket) group by all),
        labeled as (select item_id, 'page_' || id || '.md_' || chunk_index as chunk_id, url as source, chunk as content, score
          from scored join chunks on chunk_no = id * 1000000 + chunk_index join pages on page_id = id),
        ranked as (select *, row_number() over (partition by item_id order by score, chunk_id) as rank from labeled)
        select item_id as query_id, rank, chunk_id, source, content, round(score, 4) as score from ranked where rank <= 4"""
    aggregates = {"sum": "round(sum(v), 2)", "mean": "round(avg(v), 2)", "count": "count(v)", "min": "round(min(v), 2)", "max": "round(max(v), 2)"}
    numbers = f"{ITEMS}, numbers as (select flag, supplier, {number('price')} as v from items)"
    for function, expression in aggregates.items():
        sql[f"group_aggregate_{function}"] = f"""with {numbers} select supplier, {expression} as {function}_price, count(*) as "count"
            from numbers where v is not null group by supplier"""
    sql["group_aggregate_few_groups"] = f"""with {numbers} select flag, round(avg(v), 2) as mean_price, count(*) as "count"
        from numbers where v is not null group by flag"""
    return sql
