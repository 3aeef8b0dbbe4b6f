"""Registered queries: the library's operators run over star-schema tables."""

from __future__ import annotations

from surveylake.bindings.registry import Registry


def all_registries() -> list[Registry]:
    from surveylake.bindings import answers, editions, headers, incremental, marts, operators

    modules = (marts, operators, answers, headers, editions, incremental)
    return [module.REGISTRY for module in modules]
