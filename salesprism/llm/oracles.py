"""Oracle SQL of the operators that SQL can express, written from their definitions."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CRC_STEP = "case when d & 1 = 1 then xor(d >> 1, 3988292384) else d >> 1 end"
#: crc32 of the UTF-8 bytes of the text that has the hexadecimal form hx
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(hx)//2), "
    "lambda i: (instr('0123456789ABCDEF', substr(hx, 2*i+1, 1))-1)*16 + instr('0123456789ABCDEF', substr(hx, 2*i+2, 1))-1)), "
    f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda d, i: {_CRC_STEP})), 4294967295)"
)

SPELLING = (
    "with recursive r as (select doc_id, unnest(regexp_extract_all("
    f"translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) as w from documents), "
    "u as (select doc_id, w, count(*) as c from r group by 1, 2), "
    "x as (select w, c, hex(concat(coalesce(cast(doc_id as varchar), ''), ':', w)) as hx from u), "
    f"h as (select w, c, {_CRC} as h from x), "
    "s as (select case when h % 97 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, c from h), "
    "v as materialized (select word, cast(sum(c) as bigint) as n from s where length(word) >= 5 group by word having sum(c) >= 3), "
    "e as materialized (select word, i, substr(word, 1, i-1) || substr(word, i+1) as rest from (select word, unnest(range(1, length(word)+1)) as i from v)), "
    "p as (select a.word as a, b.word as b from e a join e b on a.i = b.i and a.rest = b.rest where a.word <> b.word "
    "union select e.word, v.word from e join v on e.rest = v.word union select v.word, e.word from e join v on e.rest = v.word), "
    "k as (select a, b, m.n as m, count(*) over (partition by a) as n_near, "
    "row_number() over (partition by a order by m.n desc, b) as at from p join v m on m.word = b), "
    "f as materialized (select v.word, v.n, coalesce(n_near, 0) as n_near, case when m >= 2 * v.n then b end as form, case when m >= 2 * v.n then m end as form_n "
    "from v left join k on k.a = v.word and k.at = 1), "
    "t as (select word, word as root, form as ahead from f union all "
    "select t.word, f.word, f.form from t join f on f.word = t.ahead) "
    "select f.word, f.form, t.root, f.n, f.n_near, f.form_n from f join t on t.word = f.word and t.ahead is null"
)

PHRASES = (
    "with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array("
    f"translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents where text is not null), "
    "p as materialized (select lang, regexp_extract_all(piece, '[^ \\t]+') as ws from d), "
    "n as (select lang, cast(sum(len(ws)) as bigint) as n from p group by lang), "
    "g as (select lang, k, array_to_string(ws[i:i+k-1], ' ') as phrase, count(*) as f from ("
    "select lang, ws, k, unnest(range(1, len(ws)-k+2)) as i from p, (values (1), (2), (3), (4)) as s(k) where len(ws) >= k) group by 1, 2, 3), "
    "c as materialized (select *, str_split(phrase, ' ') as ws from g where f >= 30), "
    "cuts as (select lang, phrase, f as a, j, array_to_string(ws[1:j], ' ') as lp, array_to_string(ws[j+1:], ' ') as rp "
    "from (select *, unnest(range(1, k)) as j from c where k > 1)), "
    "b as (select x.lang, x.phrase, x.a, l.f as l, r.f as r, cast(2000000::hugeint * x.a // (l.f + r.f) as bigint) as score, x.j from cuts x "
    "join c l on l.lang = x.lang and l.phrase = x.lp join c r on r.lang = x.lang and r.phrase = x.rp), "
    "best as (select * from b qualify row_number() over (partition by lang, phrase order by score, j) = 1), "
    "inside as (select lang, array_to_string(ws[i:i+q-1], ' ') as phrase, max(f) as most from ("
    "select lang, ws, f, q, unnest(range(1, k-q+2)) as i from c, (values (2), (3)) as s(q) where q < k) group by 1, 2), "
    "lx as (select lang, array_to_string(ws[2:], ' ') as phrase, count(*) as x from c where k > 2 group by 1, 2), "
    "rx as (select lang, array_to_string(ws[1:k-1], ' ') as phrase, count(*) as x from c where k > 2 group by 1, 2), "
    "kept as (select best.* from best left join inside using (lang, phrase) where most is null or 100::hugeint * most < 80 * a), "
    "ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) "
    "select lang, rank, phrase, a, l, r, n, score, coalesce(lx.x, 0) as n_left, coalesce(rx.x, 0) as n_right "
    "from ranked join n using (lang) left join lx using (lang, phrase) left join rx using (lang, phrase) where rank <= 2000"
)
