"""Rule data of the compliance report.  Adding a rule adds a row."""

from __future__ import annotations

# Setting, target, check id, rule state, lowest and highest (exclusive) product
# version, server condition.
# State: live = scored, off = kept but disabled, info = target without a check.
SETTING_TARGETS = (
    ("access check cache bucket count", 0, 300, "live", None, None, None),
    ("access check cache quota", 0, 301, "live", None, None, None),
    ("Ad Hoc Distributed Queries", 0, 302, "live", None, None, None),
    ("affinity I/O mask", 0, 303, "off", None, None, None),
    ("affinity mask", 0, 304, "off", None, None, None),
    ("affinity64 I/O mask", 0, 305, "off", None, None, None),
    ("affinity64 mask", 0, 306, "off", None, None, None),
    ("Agent XPs", 1, 307, "info", None, None, None),
    ("allow polybase export", 0, 308, "info", None, None, None),
    ("allow updates", 0, 309, "live", None, None, None),
    ("automatic soft-NUMA disabled", 0, 310, "live", None, None, None),
    ("backup checksum default", 0, 311, "info", None, None, None),
    ("backup compression default", 1, 312, "live", None, None, None),
    ("blocked process threshold (s)", 0, 313, "info", None, None, None),
    ("c2 audit mode", 0, 314, "off", None, None, None),
    ("clr enabled", 1, 315, "live", "14", "15", None),
    ("clr enabled", 0, 315, "live", None, "14", None),
    ("clr enabled", 0, 315, "live", "15", None, None),
    ("clr strict security", 1, 316, "live", "14", "15", None),
    ("clr strict security", 0, 316, "live", None, "14", None),
    ("clr strict security", 0, 316, "live", "15", None, None),
    ("common criteria compliance enabled", 0, 317, "off", None, None, None),
    ("contained database authentication", 1, 318, "info", None, None, None),
    ("cost threshold for parallelism", 5, 319, "info", None, None, None),
    ("cross db ownership chaining", 0, 320, "live", None, None, None),
    ("cursor threshold", -1, 321, "info", None, None, None),
    ("Database Mail XPs", 0, 322, "live", None, None, None),
    ("default full-text language", 1031, 323, "info", None, None, None),
    ("default language", 1, 324, "info", None, None, None),
    ("default trace enabled", 1, 325, "live", None, None, None),
    ("disallow results from triggers", 0, 326, "off", None, None, None),
    ("EKM provider enabled", 0, 327, "info", None, None, None),
    ("external scripts enabled", 0, 328, "info", None, None, None),
    ("filestream access level", 0, 329, "live", None, None, None),
    ("fill factor (%)", 0, 330, "info", None, None, None),
    ("ft crawl bandwidth (max)", 100, 331, "off", None, None, None),
    ("ft crawl bandwidth (min)", 0, 332, "off", None, None, None),
    ("ft notify bandwidth (max)", 100, 333, "off", None, None, None),
    ("ft notify bandwidth (min)", 0, 334, "off", None, None, None),
    ("hadoop connectivity", 0, 335, "info", None, None, None),
    ("index create memory (KB)", 0, 336, "info", None, None, None),
    ("in-doubt xact resolution", 0, 337, "info", None, None, None),
    ("lightweight pooling", 0, 338, "live", None, None, None),
    ("locks", 0, 339, "info", None, None, None),
    ("max degree of parallelism", 0, 340, "info", None, None, None),
    ("max full-text crawl range", 4, 341, "info", None, None, None),
    ("max server memory (MB)", 2147483647, 342, "info", None, None, None),
    ("max text repl size (B)", 65536, 343, "info", None, None, None),
    ("max worker threads", 0, 344, "info", None, None, None),
    ("media retention", 0, 345, "info", None, None, None),
    ("min memory per query (KB)", 1024, 346, "info", None, None, None),
    ("min server memory (MB)", 0, 347, "info", None, None, None),
    ("nested triggers", 1, 348, "info", None, None, None),
    ("network packet size (B)", 4096, 349, "info", None, None, None),
    ("Ole Automation Procedures", 0, 350, "live", None, None, None),
    ("open objects", 0, 351, "live", None, None, None),
    ("optimize for ad hoc workloads", 0, 352, "info", None, None, None),
    ("PH timeout (s)", 60, 353, "info", None, None, None),
    ("polybase network encryption", 1, 354, "info", None, None, None),
    ("precompute rank", 0, 355, "info", None, None, None),
    ("priority boost", 0, 358, "live", None, None, None),
    ("query governor cost limit", 0, 359, "info", None, None, None),
    ("query wait (s)", -1, 360, "info", None, None, None),
    ("recovery interval (min)", 0, 361, "info", None, None, None),
    ("remote access", 1, 362, "live", None, None, None),
    ("remote admin connections", 0, 363, "live", None, None, "single"),
    ("remote admin connections", 1, 363, "live", None, None, "clustered"),
    ("remote data archive", 0, 364, "info", None, None, None),
    ("remote login timeout (s)", 10, 365, "info", None, None, None),
    ("remote proc trans", 0, 366, "info", None, None, None),
    ("remote query timeout (s)", 600, 367, "info", None, None, None),
    ("Replication XPs", 0, 368, "info", None, None, None),
    ("scan for startup procs", 0, 369, "live", None, None, "unreplicated"),
    ("scan for startup procs", 1, 369, "live", None, None, "replicated"),
    ("server trigger recursion", 1, 370, "info", None, None, None),
    ("set working set size", 0, 371, "info", None, None, None),
    ("show advanced options", 0, 372, "info", None, None, None),
    ("SMO and DMO XPs", 1, 373, "info", None, None, None),
    ("transform noise words", 0, 374, "info", None, None, None),
    ("two digit year cutoff", 2049, 375, "info", None, None, None),
    ("user connections", 0, 376, "info", None, None, None),
    ("user options", 0, 377, "info", None, None, None),
    ("xp_cmdshell", 0, 378, "live", None, None, None),
)

# File-stream access level and what it allows.
FILESTREAM_LEVELS = (
    (1, "SQL access to file streams only"),
    (2, "SQL access and local streaming"),
    (3, "SQL access, local and remote streaming"),
)

# Version prefix, product name, latest patch level.
VERSION_NAMES = (
    ("10.0", "2008", "SP4"),
    ("10.5", "2008 R2", "SP3"),
    ("11.0", "2012", "SP4"),
    ("12.0", "2014", "SP3"),
    ("13.0", "2016", "SP2"),
    ("14.0", "2017", "CU21"),
    ("15.0", "2019", "CU7"),
)

# Expected trace flags per major version.
EXPECTED_FLAGS = (
    (15, ("7745", "3226")),
    (14, ("7752", "7745", "3226", "460")),
    (13, ("7752", "7745", "3226", "460")),
    (12, ("8079", "6534", "6533", "3449", "3226", "2371", "1118", "1117")),
    (11, ("8079", "6534", "6533", "3449", "3226", "2371", "1118", "1117")),
    (10, ("3226", "2371", "1118", "1117")),
)

# Trace flag, lowest version, highest version (exclusive), extra condition, advice.
FLAG_ADVICE = (
    ("11024", None, "13.0.5026.0", None, "applies only to newer builds"),
    ("9939", None, None, None, "not needed together with 4199"),
    ("9481", "13.0.4001.0", None, None, "use the query hint for legacy cardinality estimation"),
    ("9476", "13.0.4001.0", None, None, "use the query hint for join predicate dependence"),
    ("9471", "13.0.4001.0", None, None, "use the query hint for minimum selectivity"),
    ("9259", None, None, None, "undocumented, hurts performance"),
    ("9024", "12.0.4100.1", None, None, "no effect, engine default"),
    ("8649", None, None, None, "drops the parallelism threshold to zero"),
    ("8079", "14", None, None, "no effect, engine default"),
    ("8075", "14", None, None, "no effect, engine default"),
    ("8048", "14", None, None, "no effect, engine default"),
    ("8032", None, None, None, "large caches take memory from other consumers"),
    ("8017", None, None, "express", "default of the express edition"),
    ("8017", None, None, "not express", "disables schedulers for all processors"),
    ("7752", "15", None, None, "no effect, engine default"),
    ("7745", "14", None, None, "no effect, engine default"),
    ("7412", "15", None, None, "no effect, profiling is on by default"),
    ("7412", None, "13.0.4001.0", None, "applies only to newer builds"),
    ("6533", "13", None, None, "no effect, engine default"),
    ("6532", "13", None, None, "no effect, engine default"),
    ("6498", "13", None, None, "no effect, engine default"),
    ("4199", None, "13.0.4001.0", None, "use the query hint"),
    ("4199", "13", None, None, "only for specific performance issues"),
    ("4139", "13.0.4001.0", None, None, "use the query hint for ascending keys"),
    ("4138", "13.0.4001.0", None, None, "use the query hint for row goals"),
    ("4137", "13.0.4001.0", None, None, "use the query hint for minimum selectivity"),
    ("4136", "13.0.4001.0", None, None, "use the query hint for parameter sniffing"),
    ("3656", None, None, None, "debugging flag, not for production"),
    ("3608", None, None, None, "some features do not work"),
    ("3505", None, None, None, "disables checkpoints"),
    ("3468", None, "13.0.4451.0", None, "applies only to newer builds"),
    ("3459", None, "13", None, "applies only to newer versions, remove"),
    ("3449", None, "11.0.6537.0", None, "applies only to newer builds, remove"),
    ("3427", "14", None, None, "no effect, remove"),
    ("3023", "12", None, None, "use the checksum default option"),
    ("2422", None, "13.0.5026.0", None, "applies only to newer builds, remove"),
    ("2371", "13", None, None, "no effect, remove"),
    ("2340", "13.0.4001.0", None, None, "use the query hint"),
    ("2330", None, None, None, "disables index usage collection"),
    ("2312", "13.0.4001.0", None, None, "use the query hint for default cardinality estimation"),
    ("1806", None, None, None, "disables instant file initialisation"),
    ("1237", "14", None, None, "no effect, remove"),
    ("1236", "12.0.4100.1", None, None, "no effect, remove"),
    ("1224", None, None, None, "disables lock escalation by lock count"),
    ("1211", None, None, None, "disables lock escalation"),
    ("1118", "13", None, None, "no effect, remove"),
    ("1117", "13", None, None, "no effect, remove"),
    ("876", None, "15", None, "applies only to newer versions, remove"),
    ("834", None, "15", "columnstore", "not together with columnstore, remove"),
    ("834", "15", None, "columnstore", "use 876 instead, remove"),
    ("692", "13", None, None, "applies only to specific builds"),
    ("661", None, None, None, "disables ghost record removal, turn off"),
    ("652", None, None, None, "disables read-ahead, turn off"),
)

# Integrity error numbers and advice.
ERROR_ADVICE = (
    ((1823, 3313, 5128, 7928, 8921), "not enough room for the check snapshot"),
    ((8928, 8944), "restore from a valid backup, do not repair first"),
    ((8946, 8998), "allocation pages are damaged, restore"),
    ((8941, 8942), "drop and recreate the damaged indexes"),
    ((7985,), "critical system tables are damaged"),
    ((665, 1450), "snapshot writes failed, check disk space"),
    ((17053,), "snapshot recovery message, by design"),
    ((2508,), "update usage counts"),
    ((8964,), "damaged large-object pages"),
    ((2570,), "correct the out-of-range values by hand"),
    ((8976,), "restore the damaged pages from backup"),
    ((3853,), "system metadata is inconsistent, restore"),
    ((1222,), "lock time-out, shorten transactions"),
)
DEFAULT_ERROR_ADVICE = "not necessarily corruption, stop backup deletion and investigate"

# Grants every public role has (permission, class, object id).
PUBLIC_DEFAULTS = (
    ("VIEW ANY DATABASE", "SERVER", 0),
    ("CONNECT", "ENDPOINT", 2),
    ("CONNECT", "ENDPOINT", 3),
    ("CONNECT", "ENDPOINT", 4),
    ("CONNECT", "ENDPOINT", 5),
)

# User tables allowed inside a system database.
SYSTEM_TABLE_ALLOW = (
    ("master", "CommandLog"),
    ("msdb", "CommandLog"),
    ("msdb", "Queue"),
    ("msdb", "QueueDatabase"),
)

# Maintenance procedures and their expected version.
TOOLSET_EXPECTED = (
    ("CommandExecute", "2020-01-26 14:06:53"),
    ("DatabaseBackup", "2020-01-26 14:06:53"),
    ("DatabaseIntegrityCheck", "2020-01-26 14:06:53"),
    ("IndexOptimize", "2020-01-26 14:06:53"),
)
