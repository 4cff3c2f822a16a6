"""Where the smallest tables lie. A module of its own name: several folders hold a conftest."""

SF_SMALL = "/root/testdata/sf0.001"
