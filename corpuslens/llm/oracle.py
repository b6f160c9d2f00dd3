"""The same rows as two of the queries in plain SQL for DuckDB; the others have no SQL form and are tested by brute force."""

CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
    select *, 10 + length(role) + length(regexp_replace(text,
        '(\\*)(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>)', '\1\\\2', 'g')) as chars,
        row_number() over (partition by conv_id order by turn desc, role desc, text desc) = 1 as ends
    from turns),
grown as (
    select *, sum(chars) over (partition by conv_id order by turn, role, text rows unbounded preceding) as so_far from sized)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    coalesce(sum(so_far) filter (role = 'assistant' or ends), 0)::bigint as formatted_chars
from grown group by conv_id
"""

SUBSTRINGS = r"""
with cut as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]+[.!?\n]*|[.!?\n]+') as parts from documents),
parts as (
    select doc_id, unnest(parts) as part, generate_subscripts(parts, 1) as k from cut),
placed as (
    select doc_id, k, sum(length(part)) over (partition by doc_id order by k) as stop, length(part) as size,
        trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) as norm
    from parts),
units as (
    select doc_id, stop - size as start, stop, norm, len(string_split(norm, ' ')) as words,
        row_number() over (partition by doc_id order by k) as unit
    from placed where norm <> ''),
ranked as (
    select *, row_number() over (partition by norm order by doc_id, start) as nth,
        first_value(doc_id) over (partition by norm order by doc_id, start) as first_doc_id,
        first_value(start) over (partition by norm order by doc_id, start) as first_start
    from units),
runs as (
    select *, unit - row_number() over (partition by doc_id order by unit) as run from ranked where nth > 1)
select doc_id, min(start)::bigint as start, max(stop)::bigint as stop, sum(words)::bigint as words, count(*) as units,
    arg_min(first_doc_id, start) as first_doc_id, arg_min(first_start, start)::bigint as first_start
from runs group by doc_id, run having sum(words) >= 20
"""

COLLOCATIONS = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9), 'abcdefghijklmnopqrstuvwxyz '), '[.,;:!?\n\x0B\f\r]')) as piece
    from documents),
listed as (
    select lang, list_filter(string_split(piece, ' '), lambda w: w <> '') as w from pieces),
grams as (
    select lang, unnest(flatten(list_transform(range(1, 5), lambda k: list_transform(
        range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) as phrase
    from listed),
sizes as (select lang, sum(len(w))::bigint as n from listed group by lang),
counted as (
    select lang, phrase, count(*) as f, string_split(phrase, ' ') as w, len(string_split(phrase, ' ')) as words
    from grams group by lang, phrase having count(*) >= 30),
cuts as (
    select lang, phrase, f, w, unnest(range(1, words)) as k from counted where words > 1),
scored as (
    select c.lang, c.phrase, c.f as a, c.k, x.f as l, y.f as r, 2000000::hugeint * c.f // (x.f::hugeint + y.f) as score
    from cuts c
    join counted x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:k], ' ')
    join counted y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1:], ' ')),
best as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_phrases as (
    select lang, f, unnest(flatten(list_transform(range(2, words), lambda k: list_transform(
        range(1, words - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))))) as phrase
    from counted where words > 2),
kept as (
    select b.* from best b where not exists (
        select 1 from inner_phrases p where p.lang = b.lang and p.phrase = b.phrase and 100::hugeint * p.f >= 80::hugeint * b.a)),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join sizes using (lang) where rank <= 2000
"""

REPAIR = r"""
with recursive named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
    from conversations),
hashed as (
    select conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: ascii(c)::bigint)),
        lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
            lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 20 as hit
    from named),
damaged as (
    select conv_id, turn, case when hit = 4 then 'user' else role end as role,
        case hit when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when hit = 3 then 2 else 1 end)) as copy
    from hashed where hit <> 0),
ordered as (
    select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as kept, left(role, 1) as i,
        row_number() over (partition by conv_id order by turn nulls first, role, text) as pos, count(*) over (partition by conv_id) as n
    from damaged),
judged as (
    select *, row_number() over (partition by conv_id, role, text order by pos) as nth, lag(i) over (partition by conv_id order by pos) as before
    from ordered),
faulty as (
    select *, case when kept = '' then 'blank' when nth > 1 then 'duplicate' when right(kept, 1) not in ('.', '!', '?') then 'truncated' end as fault
    from judged),
rows as (
    select *, case when fault in ('blank', 'duplicate') then 1000000000 else 0 end as gone, (coalesce(fault, '') = 'truncated')::int as cut
    from faulty),
-- costs to the end of the conversation before row pos, from the start, behind a system, a user and an assistant turn
costs as (
    select conv_id, n + 1 as pos, 0::bigint as v0, 4::bigint as vs, 2::bigint as vu, 0::bigint as va,
        '' as l0, 'I' as ls, 'I' as lu, '' as la
    from (select distinct conv_id, n from rows)
    union all
    select conv_id, pos, w0, ws, wu, wa,
        case when w0 = d0 then 'D' when w0 = wu + 2 then 'I' when w0 = k0 then 'K' else 'R' end,
        case when ws = ds then 'D' when ws = wu + 2 then 'I' when ws = ks then 'K' else 'R' end,
        case when wu = du then 'D' when wu = wa + 2 then 'I' when wu = ku then 'K' else 'R' end,
        case when wa = da then 'D' when wa = wu + 2 then 'I' when wa = ka then 'K' else 'R' end
    from (
        select *, least(b0, 2 + wu) as w0, least(bs, 2 + wu) as ws
        from (
            select *, least(bu, 2 + ba) as wu, least(ba, 2 + bu) as wa
            from (
                select *, least(d0, k0, r0) as b0, least(ds, ks, r0) as bs, least(du, ku, ru) as bu, least(da, ka, r0) as ba
                from (
                    select r.conv_id, r.pos, 3 + v0 as d0, 3 + vs as ds, 3 + vu as du, 3 + va as da,
                        gone + cut + case i when 's' then vs when 'u' then vu else 1000000000 end as k0,
                        gone + cut + case i when 'u' then vu else 1000000000 end as ks,
                        gone + cut + case i when 'a' then va else 1000000000 end as ku,
                        gone + cut + case i when 'u' then vu else 1000000000 end as ka,
                        gone + cut + 2 + vu as r0, gone + cut + 2 + va as ru
                    from costs c join rows r on r.conv_id is not distinct from c.conv_id and r.pos = c.pos - 1))))),
-- state: the initial of the last role, 0 before the first
walk as (
    select conv_id, 1::bigint as pos, 0::bigint as step, '0' as state, '' as letter, null::varchar as said from rows where pos = 1
    union all
    select w.conv_id, w.pos + (x.letter <> 'I')::int, w.step + 1,
        case when x.letter = 'D' then w.state when x.letter = 'K' then r.i when w.state = 'u' then 'a' else 'u' end, x.letter,
        case when x.letter = 'K' then r.role || ':' || r.text
            when x.letter <> 'D' then case when w.state = 'u' then 'assistant:' else 'user:' end || case when x.letter = 'R' then r.text else '' end end
    from walk w
    join (select conv_id, pos, unnest(['0', 's', 'u', 'a']) as state, unnest([l0, ls, lu, la]) as letter from costs) x
        on x.conv_id is not distinct from w.conv_id and x.pos = w.pos and x.state = w.state and x.letter <> ''
    left join rows r on r.conv_id is not distinct from w.conv_id and r.pos = w.pos),
repaired as (
    select conv_id, string_agg(letter, '' order by step) as audit, sha256(coalesce(string_agg(said, chr(10) order by step), '')) as digest
    from walk where step > 0 group by conv_id),
totals as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (before is not null and before || i not in ('su', 'ua', 'au')) as illegal
    from rows group by conv_id)
select d.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(c.v0, 0) as cost,
    coalesce(audit, '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) d
left join totals t on t.conv_id is not distinct from d.conv_id
left join costs c on c.conv_id is not distinct from d.conv_id and c.pos = 1
left join repaired p on p.conv_id is not distinct from d.conv_id
"""
