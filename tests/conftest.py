import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from changeflow.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "changeflow-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="2",
        spark__default__parallelism="2",
        spark__ui__enabled="false",
        # tiny inputs: compiling and re-planning would cost more than the work
        spark__sql__adaptive__enabled="false",
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
