"""Expected results as DuckDB SQL, for the queries whose results SQL can state."""

#: The parity of the unsigned CRC-32 of a decimal number: 3988292384 is the polynomial.
_CRC32 = """list_reduce([4294967295] || list_transform(string_split(cast({} as varchar), ''), lambda c: cast(unicode(c) as bigint)),
                    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))))"""

STATEMENTS = {
    "op2_exact_dedup": r"""
        with texts as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
        )
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = min(doc_id) over same as kept, sha256(t) as text_sha256
        from texts window same as (partition by t)""",
    "op4_url_filter": r"""
        with parts as (
            select page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(coalesce(url, ''), '(?s)://[^/?#]*([^?#]*)', 1) as path
            from pages
        ), ruled as (
            select *, case
                when ends_with('.' || host, '.example.net') and starts_with(path, '/en/') then 'example.net/en/'
                when ends_with('.' || host, '.example.com') and starts_with(path, '/de/') then 'example.com/de/'
                when ends_with('.' || host, '.org') and starts_with(path, '/fr/') then 'org/fr/'
                when ends_with('.' || host, '.net') and starts_with(path, '/') then 'net/'
            end as rule
            from parts
        )
        select page_id, host, path, rule, case
            when rule in ('net/', 'example.com/de/') then 'block'
            when rule is not null then 'allow'
            when regexp_matches(host, '(?s)pills|casino|poker|-bets|spam|porn|viagra|malware|phishing')
              or regexp_matches('.' || host, '(?s)\.(ads-|ads\.)') then 'block'
            else 'allow'
        end as verdict
        from ruled""",
    "op12_merkle": r"""
        with recursive fields as (
            select doc_id, source, text, concat(
                       coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                       coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-')) as others,
                   case when xor(@CRC@, 4294967295) % 2 = 0 then replace(text, chr(10), '') else text end as received
            from documents
        ), leaves as (
            select doc_id, source, row_number() over (partition by source order by doc_id nulls first) - 1 as idx, count(*) over (partition by source) as n,
                   sha256(others || coalesce(strlen(text) || ':' || text, '-')) as leaf,
                   sha256(others || coalesce(strlen(received) || ':' || received, '-')) as received
            from fields
        ), trees as (
            select source, 0 as level, idx, leaf as h, n from leaves
            union all
            select source, level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), (n + 2) // 3 from trees where n > 1 group by source, level, idx // 3, n
        ), subroots as (
            select source, level as height, h as subroot, row_number() over (order by source nulls first) - 1 as idx, count(*) over () as n from trees where n = 1
        ), top as (
            select 0 as level, idx, subroot as h, n from subroots
            union all
            select level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), (n + 2) // 3 from top where n > 1 group by level, idx // 3, n
        ), nodes as (
            select source, false as is_top, level, idx, h from trees where n > 1 union all select null, true, level, idx, h from top where n > 1
        ), steps as (  -- the place of each leaf at each level, up to the root
            select l.doc_id, l.source, l.idx as leaf_idx, false as is_top, t.level, t.level as step, l.idx // cast(pow(3, t.level) as bigint) as pos
            from leaves l join (select distinct source, level from trees where n > 1) t on t.source is not distinct from l.source
            union all
            select l.doc_id, l.source, l.idx, true, t.level, s.height + t.level, s.idx // cast(pow(3, t.level) as bigint)
            from leaves l join subroots s on s.source is not distinct from l.source, (select distinct level from top where n > 1) t
        ), siblings as (
            select s.source, s.leaf_idx, s.step, coalesce(string_agg(n.h, '' order by n.idx) filter (n.idx < s.pos), '') as l,
                   coalesce(string_agg(n.h, '' order by n.idx) filter (n.idx > s.pos), '') as r
            from steps s join nodes n on n.is_top = s.is_top and (s.is_top or n.source is not distinct from s.source) and n.level = s.level and n.idx // 3 = s.pos // 3
            group by all
        ), paths as (
            select source, leaf_idx, list({'l': l, 'r': r} order by step) as path from siblings group by source, leaf_idx
        ), folded as (
            select source, idx, received as h, 0 as step from leaves
            union all
            select f.source, f.idx, sha256(p.path[f.step + 1].l || f.h || p.path[f.step + 1].r), f.step + 1
            from folded f join paths p on p.source is not distinct from f.source and p.leaf_idx = f.idx where f.step < len(p.path)
        )
        select l.doc_id, l.leaf, s.subroot, r.h as root,
               sha256(array_to_string(list_transform(coalesce(p.path, []), lambda x: x.l || x.r), '')) as proof_sha256, f.h as folded_root, f.h = r.h as verified
        from leaves l join subroots s on s.source is not distinct from l.source
        left join paths p on p.source is not distinct from l.source and p.leaf_idx = l.idx
        join folded f on f.source is not distinct from l.source and f.idx = l.idx and f.step = coalesce(len(p.path), 0),
        (select h from top where n = 1) r""".replace("@CRC@", _CRC32.format("doc_id")),
    "op11_prefix_trie": r"""
        with turns as (
            select conv_id, row_number() over (partition by conv_id order by turn nulls first) as pos, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations where conv_id is not null
        ), convs as (
            select conv_id, xor(@CRC@, 4294967295) % 4 as h, conv_id - conv_id % 20 as donor from (select distinct conv_id from turns)
        ), rebuilt as (
            select c.conv_id, 0 as part, t.pos, t.role, t.text from convs c join turns t on t.conv_id = c.donor and t.pos <= c.h
            union all
            select c.conv_id, 1, t.pos, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.pos > c.h
        ), sequences as (
            select c.conv_id, coalesce(list([r.role, r.text] order by r.part, r.pos) filter (r.pos is not null), []) as turns
            from convs c left join rebuilt r using (conv_id) group by c.conv_id
        ), prefixes as (
            select conv_id, d, turns[1:d] as path, len(turns) = d as ends from (select *, unnest(range(0, len(turns) + 1)) as d from sequences)
        ), nodes as (
            select path, d, min(conv_id) as conv_id, count(*) as n_convs,
                   sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256,
                   (count(*) - 1) * case when d = 0 then 0 else len(regexp_extract_all(path[d][2], '[^\x20\x09-\x0D]+')) end as saved
            from prefixes group by path, d
        ), born as (
            select path[1:d - 1] as path, count(*) as n_children from nodes where d > 0 group by path[1:d - 1]
        ), below as (
            select path[1:k] as path, sum(saved) as saved_tokens, sum(leaf) as n_leaves
            from (select n.path, n.saved, case when b.path is null then 1 else 0 end as leaf, unnest(range(0, n.d + 1)) as k from nodes n left join born b on b.path = n.path)
            group by path[1:k]
        )
        select n.conv_id, cast(n.d as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(b.n_children, 0) as n_children,
               cast(w.n_leaves as bigint) as n_leaves, cast(w.saved_tokens as bigint) as saved_tokens, n.ends_sha256
        from nodes n join below w on w.path = n.path left join born b on b.path = n.path
        left join nodes p on n.d > 0 and p.path = n.path[1:n.d - 1]""".replace("@CRC@", _CRC32.format("conv_id")),
}
