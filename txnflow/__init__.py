"""txnflow: payment-transaction analytics as Spark jobs.

Batch and streaming pipelines that validate, normalise, enrich and score
multi-channel transactions with four event-time fraud rules, load a star
schema, and report on it.  Every operator takes and returns a DataFrame.
"""

import sys

from pyspark import cloudpickle

from txnflow.config import DEFAULT_RULES, RuleConfig, load_rule_config

# Functions sent to Python workers carry their code, so that executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DEFAULT_RULES", "RuleConfig", "load_rule_config"]
