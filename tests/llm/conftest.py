import os
from pathlib import Path

os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).resolve().parents[2]), os.environ.get("PYTHONPATH", "")])
