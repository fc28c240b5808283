"""DuckDB SQL with the results that the queries must have."""

from __future__ import annotations

from loadwarden.llm.mixing import BLOCK_WORDS, MAX_REPEATS, SEED
from loadwarden.llm.secrets import RULES

MIXING_SQL = rf"""
with sizes as (
    select doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
    from documents
), sources as (
    select source, source_size, limit_words, weight, limit_words / weight as ratio from (
        select source, sum(size)::bigint as source_size, (sum(size) * {MAX_REPEATS})::bigint as limit_words,
            ([5, 2, 1])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
        from sizes group by source)
), levels as (
    select *, row_number() over filling as place,
        (sum(source_size) over () - coalesce(sum(limit_words) over before, 0))
        / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
    from sources
    window filling as (order by ratio, source nulls last),
        before as (order by ratio, source nulls last rows between unbounded preceding and 1 preceding)
), targets as (
    select source, source_size, least(limit_words::double, weight * level_all) as target
    from levels, (select arg_min(level, place) as level_all from levels where ratio >= level)
), passes as (
    select *, case when source_size = 0 then 0 else floor(target + 0.5)::bigint // source_size end as whole
    from targets
), blocks as (
    select doc_id, source, size, source_size, target, whole,
        floor(target + 0.5)::bigint - whole * source_size as rest, block,
        least({BLOCK_WORDS}, size - block * {BLOCK_WORDS}) as has
    from (select s.*, p.source_size, p.target, p.whole,
            unnest(range(0, greatest(1, (s.size + {BLOCK_WORDS} - 1) // {BLOCK_WORDS}))) as block
        from sizes s join passes p on s.source is not distinct from p.source)
), placed as (
    select *, sum(has) over (partition by source
        order by md5('{SEED}|pass|' || coalesce(doc_id::varchar, 'null') || '|' || whole || '|' || block))
        - has as first
    from blocks
)
select doc_id, any_value(size)::bigint as size, any_value(source_size)::bigint as source_size,
    any_value(target) as target,
    (any_value(whole) * any_value(size) + sum(greatest(0, least(has, rest - first))))::bigint as taken
from placed group by doc_id
"""


def _lists(number: int) -> str:
    """The rule's matches, what lies between them, and the part of each match that is measured."""
    rule = RULES[number]
    pattern = ("(?i)" if rule.any_case else "") + rule.pattern.replace("'", "''")
    if rule.kind == "hex":  # whole runs of its characters, so that a least length can be asked for at once
        pattern = pattern.replace("+", f"{{{rule.least},}}")
    return f"""regexp_extract_all(t, '{pattern}') as m{number}, regexp_split_to_array(t, '{pattern}') as p{number},
        regexp_extract_all(t, '{pattern}', {rule.group}) as g{number}"""


def _spans(number: int) -> str:
    """A list of the rule's spans: what comes before a match tells where it starts."""
    return f"""list_filter(list_transform(range(1, len(m{number}) + 1), lambda i: {{
        's': (length(array_to_string(p{number}[1:i], '')) + length(array_to_string(m{number}[1:i - 1], '')))::bigint,
        'k': {number}, 'n': length(m{number}[i]), 'g': length(g{number}[i])}}),
        lambda x: x.g >= {RULES[number].least})"""


_KINDS = "[" + ", ".join(f"'{rule.kind}'" for rule in RULES) + "]"
_JOINED = f"""array_to_string(list_transform({{spans}},
    lambda x: {_KINDS}[x.k + 1] || ':' || x.s || ':' || (x.s + x.n)), ',')"""

SECRETS_SQL = f"""
with matched as materialized (
    select doc_id, {", ".join(map(_lists, range(len(RULES))))}
    from (select doc_id, coalesce(text, '') as t from documents)
), found as (
    select doc_id, list_sort({" || ".join(map(_spans, range(len(RULES))))}) as all_spans from matched
), based as (select doc_id, all_spans, list_filter(all_spans, lambda x: x.k < 3) as base from found)
select doc_id,
    len(list_filter(base, lambda x: x.k = 0)) as n_assign,
    len(list_filter(base, lambda x: x.k = 1)) as n_access,
    len(list_filter(base, lambda x: x.k = 2)) as n_hex,
    sha256({_JOINED.format(spans="base")}) as base_sha256,
    {_JOINED.format(spans="all_spans")} as spans
from based
"""


VECTORS_SQL = """
with recursive vectors as materialized (
    select vec_id, case when embedding is not null and len(embedding) > 0
            and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(x)))
            and list_bool_or(list_transform(embedding, lambda x: x <> 0)) then embedding::double[] end as e
    from embeddings
), links as materialized (
    select a.vec_id as a, b.vec_id as b from vectors a join vectors b
        on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9
), reached as (
    select vec_id, vec_id as other from vectors
    union
    select r.vec_id, l.b from reached r join links l on r.other = l.a
), smallest as (select vec_id, min(other) as component_id from reached group by vec_id)
select vec_id, (select count(*) from links where a = vec_id)::bigint as n_links, component_id,
    vec_id = component_id as kept
from smallest
"""

_SAID = "md5(strlen(role) || ':' || role || text)"
_TURNS = """
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations"""

# crc32 of the number in digits, bit by bit; every prefix stands for itself as the digests of its turns.
TRIE_SQL = f"""
with turns as (
    select conv_id, {_SAID} as said, length(text) as chars,
           row_number() over (partition by conv_id order by turn nulls first, {_SAID}) - 1 as place
    from ({_TURNS}) where conv_id is not null),
convs as (
    select conv_id, conv_id - conv_id % 100 as base,
           xor(list_reduce(
               list_prepend(4294967295::bigint, flatten(list_transform(
                   string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
               lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 6 as h
    from (select distinct conv_id from turns)),
rebuilt as (
    select c.conv_id, 0 as src, t.place, t.said, t.chars
    from convs c join turns t on t.conv_id = c.base and t.place < c.h
    union all
    select c.conv_id, 1, t.place, t.said, t.chars
    from convs c join turns t on t.conv_id = c.conv_id and t.place >= c.h),
prefixes as (
    select conv_id, row_number() over w as depth, string_agg(said, '') over w as key, chars
    from rebuilt window w as (partition by conv_id order by src, place rows unbounded preceding)
    union all
    select conv_id, 0, '', 0 from convs),
lengths as (select conv_id, max(depth) as length from prefixes group by conv_id),
nodes as (
    select key, depth, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = length), '')) as ends_sha256
    from prefixes join lengths using (conv_id) group by key, depth),
children as (
    select p.key, p.depth, count(c.key) as n_children
    from nodes p left join nodes c on c.depth = p.depth + 1 and left(c.key, 32 * p.depth) = p.key
    group by p.key, p.depth),
below as (
    select p.key, p.depth, count(*) filter (k.n_children = 0) as n_leaves,
           sum((c.n_convs - 1) * c.chars)::bigint as saved_tokens
    from nodes p join nodes c on c.depth >= p.depth and left(c.key, 32 * p.depth) = p.key
    join children k on k.key = c.key and k.depth = c.depth
    group by p.key, p.depth)
select n.conv_id, n.depth::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, k.n_children, b.n_leaves,
       b.saved_tokens, n.ends_sha256
from nodes n
join children k on k.key = n.key and k.depth = n.depth
join below b on b.key = n.key and b.depth = n.depth
left join nodes u on u.depth = n.depth - 1 and u.key = left(n.key, greatest(32 * (n.depth - 1), 0)) and n.depth > 0
"""

_MARKS = "<turn>|<says>|</turn>"


def _escaped_length(column: str) -> str:
    """Code points of a text whose marks are escaped and whose last backslashes are doubled."""
    escaped = f"regexp_replace({column}, '(\\\\*)({_MARKS})', '\\1\\1\\\\\\2', 'g')"
    return f"length(regexp_replace({escaped}, '(\\\\+)$', '\\1\\1'))"


CHAT_SQL = f"""
with turns as (
    select * from ({_TURNS})
    union all values (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')),
ordered as (select *, {_SAID} as said from turns),
said as (
    select conv_id, count(*) as n_turns,
           string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, said) as turns,
           coalesce(string_agg(text, '' order by turn nulls first, said) filter (role = 'assistant'), '') as loss,
           sum({_escaped_length("role")} + {_escaped_length("text")} + {sum(map(len, _MARKS.split("|")))})::bigint
               as formatted_chars
    from ordered group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
       formatted_chars
from said
"""

COLLOCATIONS_SQL = """
with pieces as (
    select coalesce(lang, 'und') as lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') as words
    from (select lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\\x0A-\\x0D]')) as piece
          from documents)),
totals as (select lang, sum(len(words))::bigint as n from pieces group by lang),
counts as (
    select lang, k, phrase, count(*) as f
    from (select lang, k, unnest(list_transform(
              range(1, greatest(len(words) - k + 2, 1)), lambda i: array_to_string(words[i:i + k - 1], ' '))) as phrase
          from pieces, range(1, 6) sizes(k))
    group by lang, k, phrase having count(*) >= 100),
several as (select *, string_split(phrase, ' ') as words from counts where k > 1),
cuts as (
    select s.lang, s.k, s.phrase, s.f, c.cut, l.f as l, r.f as r, t.n,
           (1000::hugeint * s.f * t.n // (l.f::hugeint * r.f))::bigint as score
    from several s
    join range(1, 5) c(cut) on c.cut < s.k
    join counts l on l.lang = s.lang and l.phrase = array_to_string(s.words[1:c.cut], ' ')
    join counts r on r.lang = s.lang and r.phrase = array_to_string(s.words[c.cut + 1:], ' ')
    join totals t on t.lang = s.lang),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
    select s.lang, array_to_string(s.words[b.i:b.i + z.size - 1], ' ') as phrase, max(s.f) as f
    from several s
    join range(2, 5) z(size) on z.size < s.k
    join range(1, 5) b(i) on b.i + z.size - 1 <= s.k
    group by all)
select b.lang, row_number() over (partition by b.lang order by b.score desc, b.f desc, b.phrase) as rank, b.phrase,
       b.f as a, b.l, b.r, b.n, b.score
from best b left join inside i on i.lang = b.lang and i.phrase = b.phrase
where i.f is null or 100 * i.f < 100 * b.f
qualify rank <= 2000
"""
