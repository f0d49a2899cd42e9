"""Where the tests find the standard tables."""

import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
