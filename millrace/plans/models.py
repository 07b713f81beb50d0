"""The model graph and its build (BLD-1, BLD-2, DQ-4, DQ-5).

Nine models, each a function from the table store to a DataFrame, with tags
and dependencies like the reference's model files.  ``build`` resolves a
selector (``tag:x``, ``+tag:x`` = with all ancestors, or model names), runs
the models in dependency order, checks contracts before writing, writes each
table and runs its data tests on what was written.

A run reads only what changed (MOD-2, MOD-3, MOD-5, MOD-6, MOD-8, MOD-9):

* Row-wise models follow their source batch by batch, under the same ids.
* Invoice models are merged from partial aggregates, one per Silver batch
  (``state.*``): sums of sums, extremes of extremes, the greatest latest event,
  unions of stage sets.  Merging reads a row per invoice and batch, not Silver.
* What is built of a batch carries a fingerprint: the batch's write id and a
  digest of the code that built it (column specs, casts, aggregates).  A batch
  that was written again, or changed code, rebuilds exactly what it touches.

A source that isn't made of batches is read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from millrace.functions import casts, metrics
from millrace.operators import latest, marts, quality, silver
from millrace.store import SOURCE_MARK, WRITE_MARK, TableStore

SILVER_RULES = (silver, casts)
MART_RULES = (marts, metrics, latest)


@dataclass(frozen=True)
class Derived:
    """A table that follows ``source`` batch by batch."""

    source: str
    table: str
    build: Callable[[DataFrame], DataFrame]
    rules: tuple                       # the modules whose code decides the result


@dataclass(frozen=True)
class Model:
    name: str
    table: str
    tags: frozenset
    deps: tuple = ()
    sources: tuple = ()
    build: Callable[[TableStore, object], DataFrame] = field(default=None, compare=False)
    # row-wise models: the result of one batch of another table, kept as the same batch
    per_batch: Derived | None = field(default=None, compare=False)
    # merged models: partial aggregates of the batches, and what becomes of all of them
    partial: Derived | None = field(default=None, compare=False)
    merge: Callable[[DataFrame, TableStore, object], DataFrame] | None = field(default=None, compare=False)


INVOICE_PARTS = Derived("silver.erp", "state.invoice", marts.erp_partial, MART_RULES)
FLOW_PARTS = Derived("silver.workflow", "state.invoice_flow", marts.workflow_partial, MART_RULES)


def _models() -> dict[str, Model]:
    def m(name, table, tags, deps=(), sources=(), fn=None, follows=None, partial=None, merge=None):
        per_batch = Derived(follows[0], table, follows[1], follows[2]) if follows else None
        return Model(name, table, frozenset(tags), tuple(deps), tuple(sources), fn, per_batch, partial, merge)

    return {x.name: x for x in [
        m("stg_customer", "silver.customer", ["customer"], sources=["bronze.customer"],
          fn=lambda s, a: silver.silver_customer(s.read("bronze.customer"))),
        m("stg_erp", "silver.erp", ["erp"], sources=["bronze.erp"],
          fn=lambda s, a: silver.silver_erp(s.read("bronze.erp")), follows=("bronze.erp", silver.silver_erp, SILVER_RULES)),
        m("stg_workflow", "silver.workflow", ["workflow"], sources=["bronze.workflow"],
          fn=lambda s, a: silver.silver_workflow(s.read("bronze.workflow")),
          follows=("bronze.workflow", silver.silver_workflow, SILVER_RULES)),
        m("dim_invoice", "mart.dim_invoice", ["erp", "workflow"], ["stg_erp"],
          fn=lambda s, a: marts.dim_invoice(s.read("silver.erp")),
          partial=INVOICE_PARTS, merge=lambda parts, s, a: marts.dim_invoice_of(parts)),
        m("fact_invoice", "mart.fact_invoice", ["erp"], ["stg_erp"],
          fn=lambda s, a: marts.fact_invoice(s.read("silver.erp")), follows=("silver.erp", marts.fact_invoice, MART_RULES)),
        m("fact_workflow_event", "mart.fact_workflow_event", ["workflow"], ["stg_workflow"],
          fn=lambda s, a: marts.fact_workflow_event(s.read("silver.workflow")),
          follows=("silver.workflow", marts.fact_workflow_event, MART_RULES)),
        m("customer", "mart.customer", ["customer"], ["stg_customer"],
          fn=lambda s, a: marts.mart_customer(s.read("silver.customer"))),
        # One aggregate over Silver gives the dimension + totals join's rows.
        m("erp", "mart.erp", ["erp", "powerbi"], ["dim_invoice", "fact_invoice"],
          fn=lambda s, a: marts.mart_erp(s.read("silver.erp"), a),
          partial=INVOICE_PARTS, merge=lambda parts, s, a: marts.mart_erp_of(parts, a)),
        m("workflow", "mart.workflow", ["workflow", "powerbi"], ["dim_invoice", "fact_workflow_event"],
          fn=lambda s, a: marts.mart_workflow(s.read("silver.workflow"), s.read("mart.dim_invoice")),
          partial=FLOW_PARTS, merge=lambda parts, s, a: marts.mart_workflow_of(parts, s.read("mart.dim_invoice"))),
    ]}


MODELS = _models()


def select(selector: str, models: dict[str, Model] = MODELS) -> list[Model]:
    """Resolve a selector to models in dependency order.

    ``tag:x`` selects models tagged x; a leading ``+`` adds every ancestor;
    a bare name selects that model; several selectors may be space-separated.
    """
    chosen: set[str] = set()
    for part in selector.split():
        with_parents = part.startswith("+")
        part = part.lstrip("+")
        if part.startswith("tag:"):
            hit = {n for n, x in models.items() if part[4:] in x.tags}
        elif part in models:
            hit = {part}
        else:
            raise ValueError(f"Unknown selector: {part}")
        if not hit:
            raise ValueError(f"Selector matches no model: {part}")
        if with_parents:
            stack = list(hit)
            while stack:
                for d in models[stack.pop()].deps:
                    if d not in hit:
                        hit.add(d)
                        stack.append(d)
        chosen |= hit
    order, seen = [], set()

    def visit(n):
        if n in seen:
            return
        seen.add(n)
        for d in models[n].deps:
            if d in chosen:
                visit(d)
        order.append(models[n])

    for n in models:  # declaration order breaks ties deterministically
        if n in chosen:
            visit(n)
    return order


def build(store: TableStore, selector: str, as_of=None,
          models: dict[str, Model] = MODELS) -> list[tuple]:
    """Build the selected models; returns (model, table, rows, status) rows.
    Raises on a missing source, a broken contract or a failed data test."""
    report = []
    for model in select(selector, models):
        for src in model.sources:
            if not store.exists(src):
                raise RuntimeError(f"Model {model.name} needs source {src}, which has not been loaded")
        derived = model.per_batch or model.partial
        by_batch = derived is not None and bool(store.batches(derived.source))
        if by_batch:
            follow(store, derived, model.name if model.per_batch else None)
        if not (by_batch and model.per_batch):
            df = model.merge(store.read(derived.table), store, as_of) if by_batch else model.build(store, as_of)
            quality.enforce_contract(df, model.name)
            store.overwrite(model.table, df)
        written = store.read(model.table)
        quality.assert_passing(quality.run_tests(written, model.name))
        report.append((model.name, model.table, written.count(), "SUCCESS"))
    return report


def rules_digest(modules: tuple) -> str:
    """Digest of the modules' code (as their loader finds it, zipped or not)."""
    digest = hashlib.sha256()
    for m in modules:
        digest.update(m.__loader__.get_data(m.__file__))
    return digest.hexdigest()


def follow(store: TableStore, derived: Derived, contract: str | None = None) -> list[str]:
    """Bring a batch-wise table up to its source: batches whose fingerprint
    isn't that of the source's batch and today's rules are built (and
    returned), those the source no longer has are dropped."""
    want, have = store.committed(derived.source), set(store.batches(derived.table))
    if not have and store.fs.exists(store.path(derived.table)):
        store.drop(derived.table)            # written whole before
    written, built_of = store.marks(derived.source, WRITE_MARK), store.marks(derived.table, SOURCE_MARK)
    rules = rules_digest(derived.rules)
    prints = {b: hashlib.sha256(f"{written.get(b)} {rules}".encode()).hexdigest()[:40] for b in want}
    stale = [b for b in want if b not in have or built_of.get(b) != prints[b]]
    for batch in stale:
        df = derived.build(store.read_batch(derived.source, batch))
        if contract:
            quality.enforce_contract(df, contract)
        if len(want) == 1 and have - {batch}:
            store.replace_batches(derived.table, df, batch, prints[batch])     # after a replace load: one swap
            have = set()
        else:
            store.write_batch(derived.table, df, batch, prints[batch])
    for batch in have - set(want):
        store.drop_batch(derived.table, batch)
    return stale
