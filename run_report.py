"""spark-submit entry point: ``spark-submit --py-files incidentlens.zip run_report.py --tables ... --out ...``
(or ``python -m incidentlens ...`` where PySpark is installed). Options: see ``incidentlens/__main__.py``."""

from incidentlens.__main__ import main

if __name__ == "__main__":
    main()
