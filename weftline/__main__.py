"""python -m weftline SAMPLESHEET OUT [options]: run the benchmark on every database of a sample sheet."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators.catalog import option_list
from .operators.graph_models import NetworkConfig, ParsimonyConfig
from .plans.benchmark import Options, run


def main() -> None:
    p = argparse.ArgumentParser(prog="weftline", description=__doc__)
    p.add_argument("samplesheet")
    p.add_argument("out")
    p.add_argument("--features", default="aacomp")
    p.add_argument("--models", default="random_forest", help="random_forest, neural_network, network, parsimony, or none")
    p.add_argument("--skip", default="", help="names to leave out of features and models")
    p.add_argument("--config", help="JSON file: model name -> its settings")
    p.add_argument("--ontology")
    p.add_argument("--properties", help="CSV of residue descriptors")
    p.add_argument("--most-per-pair", type=int)
    p.add_argument("--bootstrap", type=int, default=1000)
    p.add_argument("--seed", type=int, default=42)
    a = p.parse_args()
    config = json.load(open(a.config)) if a.config else {}
    names = option_list(a.models, a.skip)
    graph = {n: c(**config.get(n, {})) for n, c in (("network", NetworkConfig), ("parsimony", ParsimonyConfig)) if n in names}
    options = Options(option_list(a.features, a.skip), [n for n in names if n not in graph], config, graph, a.ontology, a.properties, a.most_per_pair, a.bootstrap, a.seed)
    run(SparkSession.builder.getOrCreate(), a.samplesheet, a.out, options).show(truncate=False)


if __name__ == "__main__":
    main()
