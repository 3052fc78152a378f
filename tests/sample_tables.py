"""Where the smallest sample tables lie."""

SMALL = "/root/testdata/sf0.001"
