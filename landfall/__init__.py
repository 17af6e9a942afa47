"""landfall: a metadata-driven landing -> staging/reject -> ODS loader on Spark.

Public entry points:

* ``landfall.operators.validate.validate`` - all row checks, uniqueness and flag
* ``landfall.operators.split`` - clean / reject / blank rows and load counts
* ``landfall.operators.ods.stage_to_ods`` - hard deletes, audit columns, typed cast
* ``landfall.plans.metadata`` - rules, keys, names and strategies from metadata
* ``landfall.plans.schema`` - table definitions (DDL text and StructTypes)
* ``landfall.plans.load.run_load`` - the whole job for selected files and a date
"""

from landfall.operators.validate import validate  # noqa: F401
from landfall.plans.load import run_load  # noqa: F401
