"""Spark-native data curation and quality operators.

Entry points: :func:`curate.plans.run.run_all` (archives -> bronze -> silver
-> reports), :func:`curate.plans.silver.run_silver`, the operators in
:mod:`curate.operators`, the column functions in :mod:`curate.functions` and
the declarative specs in :mod:`curate.spec`.
"""

from curate.session import checkpoint_dir, get_session
from curate.spec import ENCOUNTERS, DimSpec, FactSpec, FkSpec, Rule

__version__ = "0.1.0"

__all__ = ["ENCOUNTERS", "DimSpec", "FactSpec", "FkSpec", "Rule", "checkpoint_dir",
           "get_session", "run_all", "run_silver"]


def run_all(*args, **kwargs):
    """See :func:`curate.plans.run.run_all`."""
    from curate.plans.run import run_all as _run_all
    return _run_all(*args, **kwargs)


def run_silver(*args, **kwargs):
    """See :func:`curate.plans.silver.run_silver`."""
    from curate.plans.silver import run_silver as _run_silver
    return _run_silver(*args, **kwargs)
