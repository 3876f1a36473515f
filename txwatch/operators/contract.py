"""Data contracts compiled to schemas, readers, column maps and rules.

A contract is a dict (or a JSON or YAML file) with ``sources`` (columns with
``type``, ``required``, ``values``, ``min``), ``unified_schema`` (the same, and
``unique``), ``quality_rules`` by name and ``sla``. Nothing about a source or a
rule is typed in the code: a column that the contract adds, a value it allows or
a bound it sets changes the reader and the gate.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwatch import schemas as S
from txwatch.functions import columns as C
from txwatch.operators.quality import _rules

#: How a contract's types are read from text; times are parsed afterwards, so that a bad one is one row's fault.
READ_AS = {"datetime": T.StringType(), "string": T.StringType(), "float": T.DoubleType(), "integer": T.LongType(), "boolean": T.BooleanType()}
#: Which source columns may stand for a unified one, the first that the source has.
STANDS_FOR = {
    "sender_account": ("sender_account", "from_account", "account"),
    "receiver_account": ("receiver_account", "to_account", "account_1"),
    "sender_bank": ("sender_bank", "from_bank"),
    "receiver_bank": ("receiver_bank", "to_bank"),
    "amount": ("amount", "amount_paid"),
    "payment_currency": ("payment_currency", "currency"),
    "receiving_currency": ("receiving_currency", "currency"),
    "payment_type": ("payment_type", "payment_format"),
}
BROKEN = "broken_line"


def load(path: str) -> dict:
    """A contract file; YAML only where its reader is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML contracts need PyYAML; JSON ones do not") from e
    return yaml.safe_load(text)


def default_contract() -> dict:
    """The contract of the two sources as this engine's schemas state them."""
    names = {T.DoubleType(): "float", T.IntegerType(): "integer", T.LongType(): "integer", T.StringType(): "string"}

    def column(name: str, kind: str) -> dict:
        kind = "datetime" if name == "timestamp" else kind
        return {"type": kind, "required": name != "typology", **({"values": [0, 1]} if name == "is_laundering" else {})}

    raw = {"account_sender": "account", "account_receiver": "account_1"}
    ibm = {f.name.lower().replace(" ", "_"): names[f.dataType] for f in S.BRONZE_CSV_SCHEMA.fields}
    second = {f.name: names[f.dataType] for f in S.SAML_CSV_SCHEMA.fields}
    kinds = {"amount": "float", "is_laundering": "integer"}
    unified = {c: column(c, kinds.get(c, "string")) for c in S.UNIFIED_COLUMNS}
    unified["transaction_id"]["unique"] = True
    unified["amount"]["min"] = 0
    unified["source"]["values"] = [S.SOURCE_IBM, S.SOURCE_SAML]
    return {"sources": {S.SOURCE_IBM: {"columns": {raw.get(c, c): column(raw.get(c, c), k) for c, k in ibm.items()}},
                        S.SOURCE_SAML: {"columns": {c: column(c, k) for c, k in second.items()}}},
            "unified_schema": {"columns": unified},
            "quality_rules": ["valid_currency_codes", "timestamp_not_future"]}


@dataclass
class Contract:
    spec: dict

    def columns(self, source: str | None = None) -> dict[str, dict]:
        """The columns of a source, of the unified layout by default."""
        if source is None:
            return self.spec["unified_schema"]["columns"]
        if source not in self.spec["sources"]:
            raise ValueError(f"the contract has no source {source!r}")
        return self.spec["sources"][source]["columns"]

    def schema(self, source: str) -> T.StructType:
        """How a source's CSV is read: by position, in the contract's order."""
        return T.StructType([T.StructField(name, READ_AS[c["type"]]) for name, c in self.columns(source).items()])

    def read(self, spark: SparkSession, path: str, source: str, header: bool = True) -> DataFrame:
        """The source's CSV with ``broken_line``: the text of a line that does not
        fit the schema (too few or many fields, a number that is none), else null,
        and ``file``."""
        schema = T.StructType([*self.schema(source).fields, T.StructField(BROKEN, T.StringType())])
        raw = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", BROKEN).csv(path))
        return raw.select("*", F.col("_metadata.file_path").alias("file"))

    def unified(self, rows: DataFrame, source: str) -> DataFrame:
        """A source's rows in the unified layout (columns that it lacks are null)."""
        have, out = self.columns(source), {}
        for name, c in self.columns().items():
            at = next((x for x in STANDS_FOR.get(name, (name,)) if x in have), None)
            value = F.lit(None) if at is None else F.col(f"`{at}`")
            if c["type"] == "datetime":
                value = F.lit(None).cast("timestamp_ntz") if at is None else C.parse_timestamp(value)
            elif name.endswith("_currency"):
                value = C.currency_code(value)
            out[name] = value if c["type"] == "datetime" else value.cast(READ_AS[c["type"]])
        out["source"] = F.lit(source)
        mapped = rows.select(*[v.alias(n) for n, v in out.items()],
                             *([F.col("`timestamp`").alias("_time")] if "timestamp" in have else [F.lit(None).cast("string").alias("_time")]))
        if "transaction_id" in out and "transaction_id" not in have:
            mapped = mapped.withColumn("transaction_id", C.transaction_id("source", "_time", "sender_account", "receiver_account", "amount", "payment_type"))
        return mapped.drop("_time")

    def rules(self, run_ts: str | None = None) -> list[tuple[str, Column]]:
        """``rule, whether a row breaks it``: from the columns' entries, then by name."""
        found = []
        for name, c in self.columns().items():
            x = F.col(f"`{name}`")
            if c.get("required"):
                found.append((f"{name}_required", x.isNull()))
            if "min" in c:
                found.append((f"{name}_at_least_{c['min']}", x < F.lit(c["min"])))
            if "max" in c:
                found.append((f"{name}_at_most_{c['max']}", x > F.lit(c["max"])))
            if "values" in c:
                found.append((f"{name}_one_of", ~x.isin(*c["values"])))
        named = self.spec.get("quality_rules", [])
        if "valid_currency_codes" in named:
            codes = list(S.CURRENCY_CODES.values())
            wrong = [~F.col(n).isin(*codes) for n in self.columns() if n.endswith("_currency")]
            found.append(("valid_currency_codes", F.exists(F.array(*[F.coalesce(w, F.lit(False)) for w in wrong]), lambda w: w)))
        if "timestamp_not_future" in named and run_ts is not None:
            found.append(("timestamp_not_future", F.col("timestamp") > F.lit(run_ts.replace("T", " ")).cast("timestamp_ntz")))
        return found

    def gate(self, unified: DataFrame, run_ts: str | None = None) -> DataFrame:
        """``rule, violations, passed``: all row rules in one aggregate; for each unique
        column the values that stand in several rows (counted on that column alone)."""
        rules = self.rules(run_ts)
        counts = unified.agg(*[F.count_if(broken).alias(f"_{i}") for i, (_, broken) in enumerate(rules)])
        report = _rules(counts, [(name, F.col(f"_{i}"), None) for i, (name, _) in enumerate(rules)])
        for name, c in self.columns().items():
            if c.get("unique"):
                twice = (unified.where(F.col(f"`{name}`").isNotNull()).groupBy(f"`{name}`").agg(F.count(F.lit(1)).alias("_n"))
                         .agg(F.count_if(F.col("_n") > 1).alias("_u")))
                report = report.unionByName(_rules(twice, [(f"{name}_unique", F.col("_u"), None)]))
        return report


def fit_lines(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows that fit, broken lines with file and text)`` of written rows of ``Contract.read``."""
    fits = F.col(BROKEN).isNull()
    return read.where(fits).drop(BROKEN, "file"), read.where(~fits).select("file", F.col(BROKEN).alias("line"))
