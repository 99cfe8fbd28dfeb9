"""CRC-32 of strings as relational DuckDB SQL, for the queries whose contract names it."""

from __future__ import annotations


def crc_ctes(strings: str, name: str = "crc") -> str:
    """Recursive CTEs ending in ``name``(s, crc): the unsigned CRC-32 of the UTF-8 bytes of each row ``s`` of ``strings``.

    The checksum is linear: what a byte adds depends on the byte and on how many follow it.
    """
    return f"""
crc_bits as (select b, 0 as k, b as v from (select range as b from range(256))
             union all select b, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from crc_bits where k < 8),
crc_table as (select b, v from crc_bits where k = 8),
crc_text as (select distinct s, hex(encode(s)) as h, strlen(s) as n from {strings} where s is not null),
crc_long as (select coalesce(max(n), 0) as m from crc_text),
crc_far as (select 0 as d, b, v from crc_table
            union all select d + 1, f.b, xor(t.v, f.v >> 8) from crc_far f, crc_table t, crc_long where t.b = f.v & 255 and d + 1 < m),
crc_zero as (select 0::bigint as n, 4294967295 as v
             union all select z.n + 1, xor(t.v, z.v >> 8) from crc_zero z, crc_table t, crc_long where t.b = z.v & 255 and z.n < m),
crc_bytes as (select s, n, h, unnest(range(n)) as i from crc_text),
crc_sum as (select c.s, c.n, bit_xor(f.v) as v from crc_bytes c
            join crc_far f on f.d = c.n - 1 - c.i and f.b = ('0x' || substr(c.h, (2 * c.i + 1)::bigint, 2))::bigint group by all),
{name} as (select t.s, xor(xor(z.v, coalesce(x.v, 0)), 4294967295) as crc
           from crc_text t join crc_zero z on z.n = t.n left join crc_sum x on x.s = t.s)"""
