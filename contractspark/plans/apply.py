"""A whole contract applied as one lazy plan, for one object or a whole contract at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.cast import rename_cast
from ..operators.convert import convert
from ..operators.expect import Rule, annotate, gate, observe_rules, rules, skipped_rules, summarize
from ..operators.commit import replace_all
from ..operators.failures import failure_counts, rejected
from ..operators.write import primary_key, write_frame
from ..sources.load import load
from ..spec import ContractError, ContractSpec, ObjectSpec, SCD2_COLUMNS, object_spec


@dataclass
class ContractResult:
    """What ``apply_contract`` plans. Nothing has run yet.

    ``frame``: the table to write (gated when ``gate_failures``; rule counts collected in flight by ``observation``).
    ``skipped``: names of rules on columns that are not there.
    ``checked``: the renamed and cast rows before the gate, for ``summary()`` and ``annotated()``.
    ``loaded``: the source columns before any conversion, for ``failures()`` and ``rejected()``.
    """

    name: str
    frame: DataFrame
    checked: DataFrame
    rules: list[Rule]
    observation: Observation | None
    key: list[str]
    skipped: list[str]
    loaded: DataFrame
    spec: ObjectSpec
    exclude: frozenset

    def summary(self) -> DataFrame:
        return summarize(self.checked, self.rules)

    def annotated(self, column: str = "_violations") -> DataFrame:
        return annotate(self.checked, self.rules, column)

    def failures(self) -> DataFrame:
        """``(column, checked, failed)``: values that can't be converted, which a lenient run turns into NULL."""
        return failure_counts(self.loaded, self.spec, self.exclude)

    def rejected(self, column: str = "_failed") -> DataFrame:
        """The source rows of those values, with what failed."""
        return rejected(self.loaded, self.spec, self.exclude, column)


def apply_contract(df: DataFrame, obj, exclude=SCD2_COLUMNS, mode: str = "strict", read_as: str = "physical",
                   gate_failures: bool = True, observe: bool = True, enforce_not_null: bool = False
                   ) -> ContractResult:
    """Load → convert → rename/cast → rules → write projection, as one plan over ``df`` (batch or stream).

    Every step is a projection (plus a filter for the gate), so Catalyst collapses them into one scan stage with
    column pruning into the source; no shuffle is added.
    """
    obj = object_spec(obj)
    staged = load(df, obj, exclude, read_as=read_as, mode=mode)
    staged = convert(staged, obj, exclude, mode=mode)
    checked = rename_cast(staged, obj, exclude, mode=mode)
    rule_list = rules(obj, checked.columns)
    out, obs = checked, None
    if observe and rule_list:
        out, obs = observe_rules(out, rule_list, name=f"rules_{obj.name}")
    if gate_failures:
        out = gate(out, rule_list, message=f"contract {obj.name}: rule failed")
    out = write_frame(out, obj, exclude, enforce_not_null=enforce_not_null)
    return ContractResult(obj.name, out, checked, rule_list, obs, primary_key(obj),
                          skipped_rules(obj, checked.columns), load(df, obj, exclude, read_as="source"), obj, frozenset(exclude))


def apply_contracts(frames: dict[str, DataFrame], contract, exclude=SCD2_COLUMNS, **kw) -> dict[str, ContractResult]:
    """Every object of a contract. All plans are built and analysed before anything is returned, so one bad
    object (unknown type, missing column, duplicate name) means no result at all (W7)."""
    contract = contract if isinstance(contract, ContractSpec) else ContractSpec.from_dict(contract)
    missing = [o.name for o in contract.objects if o.name not in frames]
    if missing:
        raise ContractError("ODCS-OBJ-002", f"no input frame for objects {missing}")
    results = {o.name: apply_contract(frames[o.name], o, exclude, **kw) for o in contract.objects}
    for r in results.values():
        r.frame.schema  # force analysis of every plan before any write
    return results


def run_together(spark: SparkSession, at_once: int) -> Callable[[list], None]:
    """A function that runs Spark jobs of independent outputs ``at_once`` at a time.

    Each job has a scheduler pool of its own (they share the cluster fairly where ``spark.scheduler.mode`` is FAIR). The first
    failure cancels the jobs under way, starts no more, waits for all threads, and is raised.
    """
    sc, tag, failures = spark.sparkContext, f"contract-run-{uuid.uuid4().hex}", []

    def run(writes: list) -> None:
        def one(k: int) -> None:
            if failures:
                return
            sc.addJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", f"{tag}-{k % at_once}")
            try:
                writes[k]()
            except BaseException as e:  # noqa: BLE001  raised below, after the other threads have ended
                failures.append(e)
            finally:
                sc.removeJobTag(tag)
                sc.setLocalProperty("spark.scheduler.pool", None)

        with ThreadPoolExecutor(at_once) as threads:
            running = {threads.submit(inheritable_thread_target(spark)(one), k) for k in range(len(writes))}
            while running:
                running = wait(running, timeout=0.2).not_done
                if failures:  # again and again: a job may just have been planned and not yet begun
                    sc.cancelJobsWithTag(tag)
        if failures:
            raise failures[0]

    return run


def run_contracts(frames: dict[str, DataFrame], contract, target_dir: str, exclude=SCD2_COLUMNS, fmt="parquet",
                  enforce_not_null: bool = True, at_once: int = 8, **kw) -> dict[str, ContractResult]:
    """W7 + W6: write each object to ``target_dir/<object>``, all or none, ``at_once`` objects at a time.

    Everything is planned first; then every object is written to a staging folder beside its target (gates and NOT NULL
    checks run there); only when all jobs have succeeded is the run committed and the new outputs take the old ones' places
    (``operators.commit``). A failed run leaves every old output as it was, and the first failure ends the other jobs.
    """
    results = apply_contracts(frames, contract, exclude, enforce_not_null=enforce_not_null, **kw)
    contract = contract if isinstance(contract, ContractSpec) else ContractSpec.from_dict(contract)
    if not contract.objects:
        return results
    spark = next(iter(frames.values())).sparkSession
    targets = [(f"{target_dir.rstrip('/')}/{o.name}", results[o.name].frame) for o in contract.objects]
    writes = [(path, lambda to, f=frame: f.write.format(fmt).save(to)) for path, frame in targets]
    replace_all(spark, writes, run_together(spark, min(at_once, len(writes))) if at_once > 1 else None)
    return results
