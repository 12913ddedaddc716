"""stockroom: warehouse tables (products, customers, orders) as Spark jobs.

Views, parameterised procedures and insert triggers are expressed with the
DataFrame / SQL API so that Catalyst plans them and the work is spread over
the cluster.  See README.md for the operator map.
"""

from stockroom.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
