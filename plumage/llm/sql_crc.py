"""DuckDB SQL for the CRC-32 of strings, for the oracles of queries that hash with it."""

from __future__ import annotations

from plumage.llm.crc import POLYNOMIAL


def crc_ctes(strings: str) -> str:
    """CTEs (for ``with recursive``) that end with ``crc(s, h)``: unsigned CRC-32 of the UTF-8 bytes of the distinct
    strings ``s`` of the relation ``strings``.

    ``share`` is what a byte followed by d bytes gives, ``zeros`` the checksum of n zero bytes.
    """
    return f"""
strings_ as (select distinct s from {strings}),
depth_ as (select coalesce(max(strlen(s)), 0) as deepest from strings_),
bits_(b, k, v) as (
  select range, 0, range from range(256)
  union all
  select b, k + 1, case when v & 1 = 1 then xor(v >> 1, {POLYNOMIAL}) else v >> 1 end from bits_ where k < 8),
table_ as (select b, v from bits_ where k = 8),
share_(b, d, v) as (
  select b, 0, v from table_
  union all
  select s.b, s.d + 1, xor(t.v, s.v >> 8) from share_ s join table_ t on t.b = s.v & 255
  where s.d < (select deepest from depth_)),
zeros_(n, v) as (
  select 0, 4294967295::bigint
  union all
  select z.n + 1, xor(t.v, z.v >> 8) from zeros_ z join table_ t on t.b = z.v & 255
  where z.n < (select deepest from depth_)),
bytes_ as (
  select s, strlen(s)::int as n, unnest(range(strlen(s)))::int as i from strings_),
crc as (
  select b.s, xor(bit_xor(x.v), xor(any_value(z.v), 4294967295)) as h
  from bytes_ b
  join share_ x on x.b = ('0x' || substr(hex(b.s), 2 * b.i + 1, 2))::int and x.d = b.n - 1 - b.i
  join zeros_ z on z.n = b.n
  group by b.s)"""
